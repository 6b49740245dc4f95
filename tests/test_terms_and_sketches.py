"""Term tables against plain containment, and mergeable sketches against the values themselves."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.labels import Lexicon, Tier
from corpusloom.operators import sketches, term_table
from corpusloom.operators.labeling import label_by_lexicon

ALPHABET = "abcdé 😀"


def word(rng, low, high):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(low, high)))


def occurrences(text, term):
    return sum(text.startswith(term, at) for at in range(len(text)))


@pytest.mark.parametrize("block_bytes", [60, 1_000_000])
def test_hits_against_plain_search(spark, rows, values, block_bytes):
    rng = random.Random(3)
    terms = list({word(rng, 1, 4) for _ in range(60)})
    texts = [(i, word(rng, 0, 60)) for i in range(80)] + [(80, None), (81, "")]
    table = rows([(t,) for t in [*terms, terms[0], "", None]], "term string")
    found = term_table.term_hits(rows(texts, "id int, text string"), F.col("text"), table, block_bytes=block_bytes)
    got = values(found.select("id", F.inline("hits")))
    assert got == sorted(
        ((i, term, occurrences(text, term)) for i, text in texts for term in terms if text and term in text), key=repr)
    assert {r.id: r.hits for r in found.where("id >= 80").collect()} == {80: None, 81: []}
    assert (len(term_table.term_blocks(table, [], block_bytes)) > 1) == (block_bytes < 1000)
    none = term_table.term_hits(rows(texts, "id int, text string"), F.col("text"), table.limit(0))
    assert {tuple(r.hits) if r.hits is not None else None for r in none.collect()} == {(), None}


def test_fifty_thousand_terms(spark, rows, values):
    rng = random.Random(5)
    letters = "abcdefghijklmnop"
    terms = {"".join(rng.choice(letters) for _ in range(rng.randint(3, 6))) for _ in range(70_000)}
    assert len(terms) > 50_000
    texts = [(i, "".join(rng.choice(letters) for _ in range(400))) for i in range(30)]
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    found = term_table.term_hits(rows(texts, "id int, text string"), F.col("text"), table)
    want = {(i, text[a : a + n]) for i, text in texts for n in range(3, 7) for a in range(len(text) - n + 1)}
    assert {tuple(r) for r in found.select("id", F.inline("hits")).select("id", "term").collect()} == {
        (i, term) for i, term in want if term in terms}


def test_walks_hold_one_automaton_and_bounded_results():
    """Results come in slices of the texts, and of several blocks no two automata are alive at once."""
    alive, most = set(), []
    plain = term_table._automaton

    class Held:
        def __init__(self, machine):
            self.machine = machine
            alive.add(id(self))
            most.append(len(alive))

        def __del__(self):
            alive.discard(id(self))

        def iter(self, text):
            return self.machine.iter(text)

    class Context:
        def broadcast(self, value):
            return type("Broadcast", (), {"value": value})

    texts = pa.array(["ab bc" * 40_000, None, "", "xbcx"] * 20)
    blocks = [pa.table({"term": ["ab", "b"]}), pa.table({"term": ["bc", "zz"]})]

    def walked(own):
        walk = term_table._walk(Context(), own, term_table._hits_in, term_table._all_hits, term_table.HITS)
        return list(walk.func(iter([texts])))

    term_table._automaton = lambda terms: Held(plain(terms))
    try:
        for own in (blocks, blocks[:1]):
            found = walked(own)
            assert len(found) >= 3 and sum(map(len, found)) == len(texts)
    finally:
        term_table._automaton = plain
    assert max(most) == 1
    whole = [row for part in walked(blocks) for row in part.to_pylist()]
    want = [{"term": "ab", "n": 40_000}, {"term": "b", "n": 80_000}, {"term": "bc", "n": 40_000}]
    assert whole == [want, None, [], [{"term": "b", "n": 1}, {"term": "bc", "n": 1}]] * 20


def test_labels_equal_the_native_lexicon(spark, rows, values):
    lexicon = Lexicon((Tier("max", 0.8, ("ab", "c")), Tier("deferred", 0.7, ("d", "ab", "é"))), "moderate", 0.5)
    rng = random.Random(7)
    texts = [(i, word(rng, 0, 4)) for i in range(60)] + [(60, None)]
    table = rows(
        [(k, at, t.level, t.confidence) for at, t in enumerate(lexicon.tiers) for k in t.keywords],
        "term string, tier int, level string, confidence double")
    frame = rows(texts, "id int, text string")
    native = label_by_lexicon(frame, ["text"], lexicon)
    for size in (1, 1000):
        assert values(term_table.label_by_terms(frame, F.col("text"), table, "moderate", 0.5, size)) == values(native)
    empty = term_table.label_by_terms(frame, F.col("text"), table.limit(0), "moderate", 0.5)
    assert {(r.urgency_level, r.confidence) for r in empty.collect()} == {("moderate", 0.5)}
    with pytest.raises(ValueError):
        term_table.label_by_terms(frame, F.col("text"), table.union(rows([("z", 0, "x", 0.1)], table.schema)), "m", 0.5)


def test_merged_sketches(spark, rows, values):
    days = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("split"),
        F.when(F.col("id") % 10 != 0, F.pow(F.rand(1) * 40, 3).cast("bigint")).alias("length"))
    days = days.union(rows([(99, "none", None)], "day long, split string, length long"))
    daily = sketches.sketch_lengths(days, "length", ["split", "day"])
    whole = sketches.merge_sketches(daily, ["split"])
    exact = days.where("length IS NOT NULL").groupBy("split").agg(F.count("length"), F.min("length"), F.max("length"))
    assert values(whole.select("split", "n", "low", "high")) == values(exact)
    found = sketches.rank_errors(days, "length", ["split"], sketches.sketch_quantiles(whole, ["split"])).collect()
    assert len(found) == 10 and max(r.error for r in found) <= 2 * sketches.rank_error()
    # Merging what was merged is the same aggregation again.
    again = sketches.merge_sketches(sketches.merge_sketches(daily, ["split", "day"]), [])
    assert again.first().n == days.where("length IS NOT NULL").count()
    assert sketches.merge_sketches(daily.limit(0), ["split"]).count() == 0
    # Up to k values a sketch is exact.
    few = sketches.sketch_lengths(rows([("a", v) for v in (1, 2, 3, 4, None)], "split string, length int"), "length", ["split"])
    assert [r.quantile for r in sketches.sketch_quantiles(few, ["split"], [0.0, 0.5, 1.0]).collect()] == [1, 2, 4]
