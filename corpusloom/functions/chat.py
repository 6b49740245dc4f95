"""Chat template as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import constants as K


def turn(role: Column | str, content: Column) -> Column:
    """One rendered message."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.concat(
        F.lit(K.TURN_START), role, F.lit("\n"), content, F.lit(K.TURN_END + "\n")
    )


def prompt_text(instruction: Column, system: str) -> Column:
    """System and user message, and the opening of the answer."""
    head = f"{K.TURN_START}system\n{system}{K.TURN_END}\n{K.TURN_START}user\n"
    tail = f"{K.TURN_END}\n{K.TURN_START}assistant\n"
    return F.concat(F.lit(head), instruction, F.lit(tail))


def completion_text(response: Column) -> Column:
    """What the conversation adds after the prompt."""
    return F.concat(response, F.lit(f"{K.TURN_END}\n"))


def legacy_prompt_text(instruction: Column, system: str) -> Column:
    """Older template: a newline before the end marker of the system and user message."""
    head = f"{K.TURN_START}system\n{system}\n{K.TURN_END}\n{K.TURN_START}user\n"
    tail = f"\n{K.TURN_END}\n{K.TURN_START}assistant\n"
    return F.concat(F.lit(head), instruction, F.lit(tail))


def legacy_completion_text(response: Column) -> Column:
    """Older template: no newline after the end marker; an empty answer adds nothing."""
    return F.when(response == "", F.lit("")).otherwise(F.concat(response, F.lit(K.TURN_END)))


def legacy_pair_text(response: Column) -> Column:
    """Older template for the answers of a pair."""
    return F.concat(response, F.lit(K.TURN_END))


def inference_text(instruction: Column, system: str) -> Column:
    """The prompt with an empty thinking block, as given to a model."""
    return F.concat(prompt_text(instruction, system), F.lit(K.EMPTY_THINKING))
