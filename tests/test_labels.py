"""Levels: keywords, structured answers, and reading a level back."""

import pytest
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import labels as L
from corpusloom.operators import labeling


def one(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_keywords_match_inside_words_and_max_comes_first(spark):
    got = one(
        spark, lambda c: L.lexicon_level(c),
        "Glaucoma screening", "He scolded them", "COLD since an avc", "nothing at all",
        "HÉMORRAGIE", "Routine BILAN", "ſtroke", "Difficultés Respiratoires", "",
    )
    assert [g["level"] for g in got] == [
        "max", "deferred", "max", "moderate", "max", "deferred", "max", "max", "moderate",
    ]
    assert [g["confidence"] for g in got[:4]] == [0.8, 0.8, 0.8, 0.7]


def test_lexicon_values():
    assert len(K.MAX_KEYWORDS) == 23 and len(K.DEFERRED_KEYWORDS) == 52


@pytest.mark.parametrize("level", K.LEVELS)
def test_round_trip(spark, level):
    bodies = ["Chest pain. It may be serious.", "  padded  ", "x" * 500, "y" * 501, ""]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, t string")
    answer = L.render_answer(F.lit(level), F.col("t"))
    got = df.orderBy("i").select(answer, L.parse_level(answer), L.answer_body(answer)).collect()
    for body, (text, parsed, back) in zip(bodies, got, strict=True):
        stripped = body.strip()
        kept = stripped if len(stripped) <= 500 else stripped[:497] + "..."
        assert parsed == level and back == kept
        assert text == (
            f"{K.LEVEL_LABELS[level]}\n\n{K.BODY_MARKER}{kept}{K.ADVICE_MARKER}{K.LEVEL_ADVICE[level]}"
        )


def test_unknown_level_renders_as_moderate(spark):
    got = one(spark, lambda c: L.render_answer(c, F.lit("b")), "odd", None)
    assert all(g.startswith("URGENCE MODÉRÉE") for g in got)


def test_body_without_markers(spark):
    whole, rest = "no marker", f"x {K.BODY_MARKER}body only"
    early = f"{K.ADVICE_MARKER}{K.BODY_MARKER}inner{K.ADVICE_MARKER}late{K.ADVICE_MARKER}"
    assert one(spark, L.answer_body, whole, rest, early) == [whole, "body only", "inner"]


def test_parse_level(spark):
    cases = {
        "URGENCE MODÉRÉE": "moderate", "urgence moderee": "moderate", "Urgence max": "max",
        "urgence maximum": None, "urgence max.": "max", "urgence max_": None,
        "urgence maxé": None, "différée": "deferred", "DIFFÉRÉE puis MAXIMALE": "max",
        "deferred": "deferred", "urgence mod": "moderate", "": None, "x" * 142 + " MAXIMALE": None,
        "x" * 142 + "MAXIMALE": "max", "x" * 143 + "MAXIMALE": None,
    }
    assert one(spark, L.parse_level, *cases) == list(cases.values())


def test_level_label(spark):
    assert one(spark, L.level_label, "max", None, "other") == [
        "URGENCE MAXIMALE", K.UNKNOWN_LEVEL_LABEL, K.UNKNOWN_LEVEL_LABEL,
    ]


def test_strip_artifacts(spark):
    cases = {
        "ok ForCanBeConverted done": "ok  done",
        "a𫟦b��c": "abc",
        "answer\n user \nignored\nassistant\nmore": "answer",
        "answer\nAssistant\n": "answer",
        "the user\nstays": "the user\nstays",
        "   x ": "x",
    }
    assert one(spark, L.strip_artifacts, *cases) == list(cases.values())


def test_strip_placeholders(spark):
    cases = {"<PERSON> a <DATE_TIME>": "a", "<b>x</b> <A> <AB1>": "<b>x</b> <A> <AB1>"}
    assert one(spark, L.strip_placeholders, *cases) == list(cases.values())


def test_follows_format(spark):
    long = "abcdefghijk"  # 11 characters
    cases = {
        f"URGENCE MAXIMALE. {long}. {long}.": True,
        f"URGENCE MAXIMALE. {long}. {long[:10]}.": False,
        f"Nothing here. {long}. {long}.": False,
        f"Urgence max. {long}. {long}. {long}": True,
        f"MAXIMALE.{' ' * 20}.{long}.{long}": False,
        "": False,
    }
    assert one(spark, L.follows_format, *cases) == list(cases.values())


def test_encode_and_decode(spark, values):
    df = spark.createDataFrame([(1, "max"), (2, "deferred"), (3, "moderate"), (4, None)], "id int, l string")
    encoded = labeling.encode_labels(df, "l")
    assert values(encoded, "id", "label_id") == [(1, 1), (2, 0), (3, 2), (4, None)]
    back = labeling.decode_labels(encoded, "label_id", ["deferred", "max", "moderate"], "back")
    assert values(back.where("id < 4").where("l <> back")) == []


@pytest.mark.parametrize("limit", [0, 100])
def test_codes_of_many_labels(spark, values, monkeypatch, limit):
    """Two thousand labels, one of them on a third of the rows; by salt and by broadcast."""
    monkeypatch.setattr(labeling, "BROADCAST_STRATA", limit * 100)
    hot = "é hot"
    rows = [(k, hot if k % 3 == 0 else f"label {k % 2000}", 0) for k in range(6000)] + [(9999, None, 0)]
    df = spark.createDataFrame(rows, "id int, l string, label_id int")
    codes = labeling.label_codes(df, "l")
    seen = sorted({label for _, label, _ in rows if label})
    assert {r.l: r.label_id for r in codes.collect()} == {label: at for at, label in enumerate(seen)}
    coded = labeling.encode_with(df, "l", codes)
    assert coded.columns == ["id", "l", "label_id"]
    assert {r.id: r.label_id for r in coded.collect()} == {i: seen.index(label) if label else None for i, label, _ in rows}
    back = labeling.decode_with(coded.drop("l"), "label_id", codes)
    assert {r.id: r.l for r in back.collect()} == {i: label for i, label, _ in rows}
    assert hot not in coded._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001


def test_label_with_a_pandas_udf(spark, values):
    import pandas as pd

    @F.pandas_udf("struct<level:string,confidence:double>")
    def by_length(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"level": ["max" if len(t) > 3 else "deferred" for t in text], "confidence": 1.0})

    df = spark.createDataFrame([(1, "abcd"), (2, "a")], "id int, t string")
    got = labeling.label_with(df, by_length, F.col("t"))
    assert values(got, "id", "urgency_level") == [(1, "max"), (2, "deferred")]
