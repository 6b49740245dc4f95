"""Operator 1: benchmark decontamination by a broadcast hash set of n-grams.  Native functions only.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.  Each run of 13
words of a benchmark item is a window; an item of fewer words, but not none, is one window.  The
hashes of all windows are broadcast and joined with the hash of every run of a text; a hit is
verified on its words.  Only hits leave their task, so texts are never shuffled.

The broadcast has at most ``BROADCAST_WINDOWS`` windows; a benchmark of more is cut into blocks by
hash and the texts are scanned once per block, with the same result.

A null text has no words and no hits.  Items without words have no window.  Rows with equal id and
text share their hits; items are told apart by their id as text, and rows without item id hit
words without counting as items.  An empty benchmark hits nothing.  Other columns pass through
``decontaminate``, whatever their names; ``overlaps`` ignores them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, stored, without

WINDOW = 13
BROADCAST_WINDOWS = 500_000
# A document is contaminated if one word in so many is hit.
SHARE = 20

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; ``lower`` is the fast way for texts that are all ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, n, gram, code): the distinct windows of each item, as words joined by a space."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0).withColumn("n", F.least(F.lit(window), F.size("words")))
    grams = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1),
                        lambda at: F.slice(F.col("words"), at, F.col("n")))
    grams = words.select("item", "n", F.explode(grams).alias("w"))
    return grams.select("item", "n", F.concat_ws(" ", "w").alias("gram"), F.xxhash64("w").alias("code")).distinct()


def _run_code(n: int):
    return lambda at: F.xxhash64(F.slice(F.col("words"), at, n))


def _hits(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, mark, at, n, gram) of every occurrence of the broadcast ``grams`` (n, gram, code)."""
    words = docs.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    codes, bounds = [], []
    for n in lengths:
        count = F.greatest(F.size("words") - n + 1, F.lit(0))
        run = F.transform(F.sequence(F.lit(1), count), _run_code(n))
        codes.append(F.when(count > 0, run).otherwise(F.array().cast("array<long>")))
        bounds.append(count)
    words = words.withColumn("codes", F.concat(*codes))
    # The outer form keeps the optimiser from computing the codes a second time to test for empty arrays.
    runs = words.select("doc_id", "mark", "words", F.posexplode_outer("codes").alias("at", "run_code"))
    met = runs.join(F.broadcast(grams), F.col("run_code") == F.col("code"))
    # The runs of each length follow each other: from the place to the length and first word.
    place, length, first = F.col("at"), F.lit(lengths[-1]), None
    first = place - reduce(lambda a, b: a + b, bounds[:-1], F.lit(0))
    for k in range(len(lengths) - 2, -1, -1):
        before = reduce(lambda a, b: a + b, bounds[:k], F.lit(0))
        inside = place < before + bounds[k]
        length = F.when(inside, F.lit(lengths[k])).otherwise(length)
        first = F.when(inside, place - before).otherwise(first)
    met = met.select("doc_id", "mark", "words", "n", "gram", first.alias("first"), length.alias("run_n"))
    same = F.concat_ws(" ", F.slice("words", F.col("first") + 1, F.col("n"))) == F.col("gram")
    return met.where((F.col("run_n") == F.col("n")) & same).select(
        "doc_id", "mark", F.col("first").alias("at"), "n", F.md5("gram").alias("gram")
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         broadcast_windows: int = BROADCAST_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Stored occurrences (doc_id, mark, at, n, gram) and the windows (item, gram) they belong to."""
    windows = stored(windows_of(benchmark, window), "windows")
    grams = windows.select("n", "gram", "code").distinct()
    per_length = {row["n"]: row["rows"] for row in grams.groupBy("n").agg(F.count("*").alias("rows")).collect()}
    lengths, blocks = sorted(per_length, reverse=True), math.ceil(sum(per_length.values()) / broadcast_windows)
    docs = docs.select("doc_id", "text")
    if lengths:
        parts = [_hits(docs, grams.where(F.pmod("code", F.lit(blocks)) == k), lengths) for k in range(blocks)]
        found = reduce(DataFrame.unionByName, parts)
    else:
        found = docs.limit(0).select("doc_id", F.lit(0).cast("long").alias("mark"), F.lit(0).alias("at"),
                                     F.lit(0).alias("n"), F.lit("").alias("gram"))
    return stored(found, "hits"), windows.select("item", F.md5("gram").alias("gram"))


def _spans(found: DataFrame) -> DataFrame:
    """Per document the hit words as disjoint ascending spans of word places, and their number."""
    spans = F.sort_array(F.collect_set(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("n")).alias("b"))))
    return found.groupBy("doc_id", "mark").agg(spans.alias("spans")).withColumn("n_hit", F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s.n + F.greatest(F.lit(0), x.b - F.greatest(s.end, x.a))).alias("n"),
                              F.greatest(s.end, x.b).alias("end")),
        lambda s: s.n.cast("long"),
    ))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """Per document: doc_id, mark (hash of its text), n_words, n_hit, n_items, items (ids as text, sorted) and contaminated."""
    found, windows = hits(docs, benchmark, window)
    spans = _spans(found).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "n_hit")
    items = found.select("doc_id", "mark", "gram").distinct().join(windows.where("item IS NOT NULL"), "gram")
    items = items.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("item")).alias("items"))
    items = items.select(F.col("doc_id").alias("_id2"), F.col("mark").alias("_mark2"), "items")
    counted = docs.select("doc_id", F.xxhash64("text").alias("mark"),
                          F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = counted.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    joined = joined.join(items, F.col("doc_id").eqNullSafe(F.col("_id2")) & (F.col("mark") == F.col("_mark2")), "left")
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "mark", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW,
                  share: int = SHARE) -> DataFrame:
    """``docs`` without its contaminated documents, or with the hit spans cut out of their texts.

    A cut span goes from its first word to the one after its last, so one separator stays.
    """
    if remove == "documents":
        return without(docs, overlaps(docs, benchmark, window, share).where("contaminated"))
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    found, _ = hits(docs, benchmark, window)
    spans = _spans(found).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "spans")
    same = docs["doc_id"].eqNullSafe(spans["_id"]) & (F.xxhash64(docs["text"]) == spans["_mark"])
    split = fresh("_pieces", docs, spans)
    # Separators and words take turns; a piece is the separators before a word and the word.
    between = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    pieces = F.regexp_extract_all("text", F.lit(f"[{between}]*+[^{between}]++"), F.lit(0))
    tail = F.regexp_extract("text", rf"[{between}]*+\z", 0)
    # Kept stretches of pieces lie between the end of all spans so far and the next span.
    kept = F.aggregate(
        spans["spans"], F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            F.when(x.a > s.end, F.array_append(s.kept, F.array_join(F.slice(split, s.end + 1, x.a - s.end), "")))
            .otherwise(s.kept).alias("kept"),
            F.greatest(s.end, x.b).alias("end")),
        lambda s: F.concat(F.array_join(s.kept, ""), F.array_join(F.slice(split, s.end + 1, F.size(split)), "")),
    )
    joined = docs.join(spans, same, "left")
    cut = joined.withColumn(split, F.when(spans["spans"].isNotNull(), pieces))
    text = F.when(spans["spans"].isNull(), docs["text"]).otherwise(F.concat(kept, tail))
    return cut.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])
