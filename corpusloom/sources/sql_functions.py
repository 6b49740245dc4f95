"""The row functions of this library by name, for ad-hoc SQL on registered views.

``register_functions`` defines temporary functions whose bodies are SQL expressions, so Spark
inlines and compiles them like any other, and ``pii_spans``, a table function for ``LATERAL`` joins.
Each equals its Python namesake; nulls give what those give.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import CLINICAL_LEXICON, LEVEL_PATTERNS, Lexicon
from corpusloom.functions.pii import PATTERN_RECOGNIZERS, Recognizer, spans_in_batch
from corpusloom.functions.text import NON_WHITESPACE_CLASS, WHITESPACE_CHARS

SPAN_COLUMNS = "type string, start int, end int, score double, text string"


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lexicon_body(lexicon: Lexicon) -> str:
    folded = "replace(replace(lower(text), 'ſ', 's'), 'ı', 'i')"
    cases = [
        f"WHEN {' OR '.join(f'contains({folded}, {quoted(k.lower())})' for k in dict.fromkeys(tier.keywords))} "
        f"THEN {quoted(tier.level)}"
        for tier in lexicon.tiers if tier.keywords
    ]
    default = quoted(lexicon.default_level)
    return f"CASE {' '.join(cases)} ELSE {default} END" if cases else default


def _body_of_answer() -> str:
    at = f"position({quoted(K.BODY_MARKER)}, answer)"
    first = f"({at} + {len(K.BODY_MARKER)})"
    stop = f"position({quoted(K.ADVICE_MARKER)}, answer, {first})"
    return (f"CASE WHEN {at} = 0 THEN answer WHEN {stop} = 0 THEN substring(answer, {first}) "
            f"ELSE substring(answer, {first}, {stop} - {first}) END")


def function_bodies(lexicon: Lexicon = CLINICAL_LEXICON) -> dict[str, tuple[str, str]]:
    """Name to (signature, expression)."""
    head = f"substring(text, 1, {K.LABEL_WINDOW_CHARS})"
    levels = " ".join(f"WHEN rlike({head}, {quoted(p)}) THEN {quoted(level)}" for level, p in LEVEL_PATTERNS.items())
    labels = " ".join(f"WHEN {quoted(level)} THEN {quoted(label)}" for level, label in K.LEVEL_LABELS.items())
    return {
        "word_count": ("(text STRING) RETURNS INT", f"regexp_count(text, {quoted(NON_WHITESPACE_CLASS + '+')})"),
        "strip_text": ("(text STRING) RETURNS STRING", f"btrim(text, {quoted(WHITESPACE_CHARS)})"),
        "lexicon_level": ("(text STRING) RETURNS STRING", _lexicon_body(lexicon)),
        "parse_level": ("(text STRING) RETURNS STRING", f"CASE {levels} END"),
        "level_label": (
            "(level STRING) RETURNS STRING", f"CASE level {labels} ELSE {quoted(K.UNKNOWN_LEVEL_LABEL)} END"),
        "answer_body": ("(answer STRING) RETURNS STRING", _body_of_answer()),
    }


def register_functions(
    spark: SparkSession, lexicon: Lexicon = CLINICAL_LEXICON, recognizers: Sequence[Recognizer] = PATTERN_RECOGNIZERS
) -> list[str]:
    """Define all functions in the session, replacing those of an earlier call; returns their names."""
    bodies = function_bodies(lexicon)
    for name, (signature, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}")
    rules = [(r.entity, r.pattern, r.score, r.languages, r.needs, r.whole) for r in recognizers]

    class Spans:
        def eval(self, text: str, language: str):
            for span in spans_in_batch(pd.Series([text]), pd.Series([language]), rules).iloc[0] or ():
                yield span["type"], span["start"], span["end"], span["score"], span["text"]

    spark.udtf.register("pii_spans", F.udtf(Spans, returnType=SPAN_COLUMNS, useArrow=True))
    return [*bodies, "pii_spans"]
