"""Text helpers against Python's own string methods."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as X

SPACES = list(X.WHITESPACE_CHARS)
SAMPLES = [
    "", " ", "a", " a ", "a b", "a b", "\x1ca\x1db\x1f", "　été à l' eau ",
    "one two  three\t\n four", "𝒳 y 𝒵", "a​b", "﻿a b", "x" * 30, " \n \t ",
]


def test_there_are_29_whitespace_characters():
    assert len(SPACES) == 29
    assert all(c.isspace() for c in SPACES)
    assert [c for c in map(chr, range(0x110000)) if c.isspace()] == sorted(SPACES)


def check(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    got = df.select(
        "i", X.strip(t), X.word_count(t), X.is_blank(t), X.has_words(t, 3), X.clip(t, 2), F.length(t)
    ).collect()
    for i, strip, words, blank, three, head, size in got:
        text = texts[i]
        assert strip == text.strip()
        assert words == len(text.split())
        assert blank == (not text.strip())
        assert three == (len(text.split()) >= 3)
        assert head == text[:2]
        assert size == len(text)


def test_helpers_agree_with_python(spark):
    check(spark, SAMPLES + [f"{c}a{c}{c}b{c}" for c in SPACES])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(SPACES + list("ab.é𝒳<&;")), max_size=30), min_size=40, max_size=60))
def test_helpers_agree_with_python_on_random_text(spark, texts):
    check(spark, texts)


def test_null_is_blank_and_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert tuple(df.select(X.is_blank(F.col("t")), X.is_empty(F.col("t"))).first()) == (True, True)


def test_fingerprint_has_no_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", "b")], "a string, b string")
    prints = [bytes(r[0]) for r in df.select(X.fingerprint(F.col("a"), F.col("b"))).collect()]
    assert prints[0] == prints[1] != prints[2]
    assert prints[0] == hashlib.md5(b"abc").digest()


def test_seeded_key(spark):
    got = spark.range(3).select(X.seeded_key(42, F.col("id"))).collect()
    assert [r[0] for r in got] == [hashlib.md5(f"42|{i}".encode()).hexdigest() for i in range(3)]


def test_literal_map(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string")
    got = df.select(X.literal_map({"a": "1", "b": "2"}, F.col("k"), "0")).collect()
    assert [r[0] for r in got] == ["1", "2", "0", "0"]
