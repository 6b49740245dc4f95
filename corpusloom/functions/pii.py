"""Personal data: recognisers, span detection, filtering and masking.

Recognisers are regular expressions, lists of names, or a user's own model.  A native regex
gate decides in the JVM which texts hold anything at all; only those travel to a Python
worker, Arrow-batched, where a small helper lists the spans with their offsets.  Filtering
and counting are native again.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import constants as K

SPAN = "struct<type:string,start:int,end:int,score:double,text:string>"
SPANS = f"array<{SPAN}>"

# A plugged-in model: texts and languages of a batch in, per text a list of
# (type, start, end, score) out.
SpanModel = Callable[[Sequence[str], Sequence[str]], Sequence[Sequence[tuple[str, int, int, float]]]]


@dataclass(frozen=True)
class Recognizer:
    """One pattern for one entity type.

    The pattern must mean the same to Java and to Python: explicit character classes, no
    look-around.  ``languages`` restricts it to rows of those languages; ``needs`` is a
    literal that every hit contains, which spares most texts the pattern.  With ``whole`` a hit
    counts only where it does not begin or end inside a word or number.
    """

    entity: str
    pattern: str
    score: float
    languages: tuple[str, ...] | None = None
    needs: str = ""
    whole: bool = False

    def occurs(self, text: Column) -> Column:
        """Whether a text has a hit."""
        hit = text.rlike(self.pattern)
        return F.contains(text, F.lit(self.needs)) & hit if self.needs else hit


def name_list(
    entity: str, names: Sequence[str], score: float = 0.85, languages: tuple[str, ...] | None = None,
    whole: bool = False,
) -> Recognizer:
    """A recogniser for fixed names, longest first; with ``whole`` not inside longer words."""
    ordered = sorted(dict.fromkeys(names), key=lambda n: (-len(n), n))
    return Recognizer(entity, "|".join(re.escape(n) for n in ordered), score, languages, whole=whole)


_MONTHS_FR = "janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre"
_MONTHS_EN = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
)

# Every repetition is bounded, so no text makes a scan quadratic.
EMAIL = Recognizer(
    "EMAIL_ADDRESS",
    r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    1.0,
    needs="@",
)
PHONE = Recognizer(
    "PHONE_NUMBER",
    r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}"
    r"|0[1-9](?:[ .-][0-9]{2}){4}",
    0.4,
)
DATE = Recognizer(
    "DATE_TIME",
    r"[0-9](?:[0-9]{3}-[0-9]{2}-[0-9]{2}"
    r"|[0-9]?/[0-9]{1,2}/[0-9]{2,4}"
    rf"|[0-9]? (?:{_MONTHS_FR}|{_MONTHS_EN}) [0-9]{{4}})"
    rf"|(?:{_MONTHS_EN}) [0-9]{{1,2}}, [0-9]{{4}}",
    0.6,
)
PATTERN_RECOGNIZERS = (EMAIL, PHONE, DATE)

# Small gazetteers of our own choosing; a job for other places brings its own lists.
PLACES = [
    "France", "Belgique", "Belgium", "Suisse", "Switzerland", "Canada", "Germany", "Allemagne", "Spain", "Espagne",
    "Italy", "Italie", "United States", "United Kingdom", "Paris", "Lyon", "Marseille", "Toulouse", "Lille",
    "Bordeaux", "Nantes", "Strasbourg", "Nice", "London", "Berlin", "Madrid", "Rome", "Brussels", "Bruxelles",
    "Geneva", "Genève", "New York", "Montréal", "Montreal",
]
GROUPS = [
    "French", "Belgian", "Swiss", "Canadian", "German", "Spanish", "Italian", "American", "British", "European",
    "Français", "Française", "Belge", "Allemand", "Allemande", "Espagnol", "Espagnole", "Italien", "Italienne",
    "Christian", "Muslim", "Jewish", "Catholic", "Protestant", "Buddhist",
]
# What the end-to-end jobs mask; PERSON takes a statistical model or the caller's own list.
DEFAULT_RECOGNIZERS = (
    *PATTERN_RECOGNIZERS,
    name_list("LOCATION", PLACES, whole=True),
    name_list("NRP", GROUPS, whole=True),
)


def uncovered_types(wanted: Sequence[str], recognizers: Sequence[Recognizer]) -> list[str]:
    """The entity types that none of the recognisers finds."""
    return sorted(set(wanted) - {r.entity for r in recognizers})


def resolve_overlaps(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Keep non-overlapping spans, preferring higher score, then longer, then earlier."""
    taken: list[tuple[int, int]] = []
    kept = []
    for span in sorted(spans, key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        start, end = span[1], span[2]
        at = bisect_left(taken, (start, end))
        if at < len(taken) and taken[at][0] < end:
            continue
        if at > 0 and taken[at - 1][1] > start:
            continue
        insort(taken, (start, end))
        kept.append(span)
    return sorted(kept, key=lambda s: s[1])


def _apart(text: str, start: int, end: int) -> bool:
    """Whether a hit neither begins nor ends inside a run of letters and digits."""
    before = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    return not before and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


def spans_in_batch(
    texts: pd.Series,
    languages: pd.Series,
    rules: Sequence[tuple[str, str, float, tuple[str, ...] | None, str, bool]],
    model: SpanModel | None = None,
) -> pd.Series:
    """The spans of every text of a batch; null for null and blank texts."""
    compiled = [(e, re.compile(p), s, langs, needs, whole) for e, p, s, langs, needs, whole in rules]
    wanted = [i for i, t in enumerate(texts) if t is not None and t.strip()]
    extra: dict[int, Sequence[tuple[str, int, int, float]]] = {}
    if model and wanted:
        found = model([texts.iloc[i] for i in wanted], [languages.iloc[i] for i in wanted])
        extra = dict(zip(wanted, found, strict=True))
    out: list[list[dict] | None] = [None] * len(texts)
    for i in wanted:
        value, language = texts.iloc[i], languages.iloc[i]
        spans = list(extra.get(i, ()))
        for entity, pattern, score, langs, needs, whole in compiled:
            if needs in value and (langs is None or language in langs):
                hits = [m.span() for m in pattern.finditer(value)]
                spans += [(entity, a, b, score) for a, b in hits if not whole or _apart(value, a, b)]
        out[i] = [
            {"type": e, "start": a, "end": b, "score": s, "text": value[a:b]}
            for e, a, b, s in resolve_overlaps(spans)
        ]
    return pd.Series(out, dtype="object")


def detect(
    text: Column,
    language: Column,
    recognizers: Sequence[Recognizer] = PATTERN_RECOGNIZERS,
    model_factory: Callable[[], SpanModel] | None = None,
) -> Column:
    """The spans of personal data in a text, in order; an empty array when there are none.

    ``model_factory`` builds a statistical recogniser once per task; without one, only texts
    that the native gate lets through reach Python.
    """
    rules = [(r.entity, r.pattern, r.score, r.languages, r.needs, r.whole) for r in recognizers]
    if model_factory is None:

        @F.pandas_udf(SPANS)
        def find(texts: pd.Series, languages: pd.Series) -> pd.Series:
            return spans_in_batch(texts, languages, rules)

        gate = reduce(lambda a, b: a | b, [r.occurs(text) for r in recognizers])
        found = find(F.when(gate, text), language)
    else:

        @F.pandas_udf(SPANS)
        def find_with_model(
            batches: Iterator[tuple[pd.Series, pd.Series]],
        ) -> Iterator[pd.Series]:
            model = model_factory()
            for texts, languages in batches:
                yield spans_in_batch(texts, languages, rules, model)

        found = find_with_model(text, language)
    return F.coalesce(found, F.array().cast(SPANS))


def is_false_person(
    entity: Column,
    score: Column,
    text: Column,
    min_score: float = K.PERSON_MIN_SCORE,
    allowlist: Sequence[str] = tuple(K.PERSON_ALLOWLIST),
) -> Column:
    """A PERSON hit that is too uncertain or contains an allow-listed term.

    Equality with a term is a case of containing it.  Other entity types are never dropped.
    """
    # Hits are short, so one alternation is cheaper to plan than a test per term.
    terms = "|".join(re.escape(t) for t in allowlist)
    allowed = F.lower(text).rlike(terms) if terms else F.lit(False)
    return (entity == "PERSON") & ((score < min_score) | allowed)


def drop_false_persons(
    spans: Column,
    min_score: float = K.PERSON_MIN_SCORE,
    allowlist: Sequence[str] = tuple(K.PERSON_ALLOWLIST),
) -> Column:
    """Remove false PERSON hits from an array of spans."""
    return F.filter(
        spans, lambda s: ~is_false_person(s["type"], s["score"], s["text"], min_score, allowlist)
    )


def mask(text: Column, spans: Column) -> Column:
    """Replace each span by ``<TYPE>``; spans are in order and do not overlap."""
    spliced = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, x: F.struct(
            F.concat(
                s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("<"), x["type"], F.lit(">")
            ).alias("out"),
            x["end"].alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, spliced).otherwise(text)
