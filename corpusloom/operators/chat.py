"""Tables in training format.  All but the conversation rendering are map-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import chat as C


def chat_format(
    df: DataFrame, row_id: str = "id", label: str = "urgency_level", system: str | None = None
) -> DataFrame:
    """``(id, prompt, completion, text, label)`` for supervised tuning."""
    prompt = C.prompt_text(F.col("instruction"), system or K.system_prompt())
    completion = C.completion_text(F.col("response"))
    return df.select(
        F.col(row_id),
        prompt.alias("prompt"),
        completion.alias("completion"),
        F.concat(prompt, completion).alias("text"),
        F.col(label),
    )


def chat_format_pairs(df: DataFrame, row_id: str = "id", system: str | None = None) -> DataFrame:
    """``(id, prompt, chosen, rejected)`` for preference tuning."""
    return df.select(
        F.col(row_id),
        C.prompt_text(F.col("prompt"), system or K.system_prompt()).alias("prompt"),
        C.completion_text(F.col("chosen")).alias("chosen"),
        C.completion_text(F.col("rejected")).alias("rejected"),
    )


def chat_format_legacy(df: DataFrame, row_id: str = "id", system: str | None = None) -> DataFrame:
    """``(id, text)`` in the older template."""
    prompt = C.legacy_prompt_text(F.col("instruction"), system or K.system_prompt())
    return df.select(
        F.col(row_id),
        F.concat(prompt, C.legacy_completion_text(F.col("response"))).alias("text"),
    )


def chat_format_pairs_legacy(
    df: DataFrame, row_id: str = "id", system: str | None = None
) -> DataFrame:
    """``(id, prompt, chosen, rejected)`` in the older template."""
    return df.select(
        F.col(row_id),
        C.legacy_prompt_text(F.col("prompt"), system or K.system_prompt()).alias("prompt"),
        C.legacy_pair_text(F.col("chosen")).alias("chosen"),
        C.legacy_pair_text(F.col("rejected")).alias("rejected"),
    )


def inference_prompts(
    df: DataFrame, row_id: str = "id", text: str = "instruction", system: str | None = None
) -> DataFrame:
    """``(id, prompt)`` ready for generation."""
    return df.select(
        F.col(row_id), C.inference_text(F.col(text), system or K.system_prompt()).alias("prompt")
    )


def render_conversations(
    df: DataFrame, conversation: str = "conv_id", turns_per_part: int | None = None
) -> DataFrame:
    """``(conversation, n_turns, text)``: the messages of each conversation in turn order.

    With ``turns_per_part`` the rows are ``(conversation, part, n_turns, text)``: parts of so
    many turns whose texts concatenate to the whole, for conversations too long for one value.
    For any length, ``render_turns`` gives one line per turn without gathering anything.
    """
    key = [conversation] if turns_per_part is None else [conversation, "part"]
    part = [] if turns_per_part is None else [F.floor(F.col("turn") / turns_per_part).cast("bigint").alias("part")]
    messages = df.select(
        F.col(conversation),
        *part,
        F.struct("turn", "role", C.turn(F.col("role"), F.col("text")).alias("line")).alias("m"),
    )
    return (
        messages.groupBy(*key)
        .agg(F.sort_array(F.collect_list("m")).alias("ms"))
        .select(
            *key,
            F.size("ms").cast("bigint").alias("n_turns"),
            F.array_join(F.col("ms")["line"], "").alias("text"),
        )
    )


def render_turns(df: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """``(conversation, turn, line)``: every message rendered alone; lines concatenate by turn."""
    return df.select(
        F.col(conversation), "turn", C.turn(F.col("role"), F.col("text")).alias("line")
    )
