"""Names from a table of any size, found in texts by joining hashed runs of words.

A name is a run of words, letters and digits in lower case, between which a text may have a space, a
hyphen, an apostrophe or a full stop and a space.  Every text is walked once: the rolling hashes of
the runs of as many words as some name has are looked up in a Bloom filter of the names, and the
runs it lets through are joined with the table by hash and compared word by word.  So what is
shuffled or broadcast is the hits and about one run in a hundred besides, whatever the texts hold.

Null and empty texts and names without a word have no hits.  Names that differ only in case or in
what stands between their words are one name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.batches import slices
from corpusloom.functions.pii import SPANS, resolve_overlaps
from corpusloom.session import materialize

SCORE = 0.85
# Bits of the filter for each name, and the most bits it may have; a fuller filter lets more through.
BITS_PER_NAME = 10
MOST_BITS = 1 << 29
FILTER_HASHES = 4
# Bytes of texts whose runs are hashed at once, and words a task remembers with their hash.
SLICE_BYTES = 1 << 20
REMEMBERED = 200_000

_WORD = regex.compile(r"[\p{L}\p{N}]+")
_CUT = regex.compile(r"([\p{L}\p{N}]+)")
_GAP = regex.compile(r"[ \-'’.]{1,2}")
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1

HITS = "start int, end int, hash long, words string"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def run_hash(words: Sequence[str]) -> int:
    """The rolling hash of a run of lower-case words."""
    value = 0
    for word in words:
        value = (value * _FACTOR + xxhash.xxh3_64_intdigest(word)) & _MASK
    return _signed(value)


def hashed_names(names: DataFrame, name: str = "name") -> DataFrame:
    """The distinct names as ``hash``, ``words`` and ``n_words``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [[w.lower() for w in _WORD.findall(text or "")] for text in batch.column(0).to_pylist()]
            split = [words for words in split if words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([run_hash(words) for words in split], pa.int64()),
                 pa.array([" ".join(words) for words in split], pa.string()),
                 pa.array([len(words) for words in split], pa.int32())],
                names=["hash", "words", "n_words"],
            )

    return names.select(name).mapInArrow(hashed, "hash long, words string, n_words int").distinct()


def _places(hash_: Column, bits: int) -> list[Column]:
    """Places of a hash in a filter of ``bits``, a power of two."""
    step = F.shiftrightunsigned(hash_, 33).bitwiseOR(F.lit(1))
    return [(hash_ + step * k).bitwiseAND(F.lit(bits - 1)) for k in range(FILTER_HASHES)]


def _filter_of(hashed: DataFrame, count: int) -> np.ndarray:
    """The Bloom filter of the names as 64-bit words, put together by Spark and bounded in size."""
    bits = 1 << min(int(math.log2(MOST_BITS)), max(10, math.ceil(math.log2(max(1, count) * BITS_PER_NAME))))
    place = hashed.select(F.explode(F.array(*_places(F.col("hash"), bits))).alias("place"))
    word = F.shiftright("place", 6).cast("int").alias("word")
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = place.groupBy(word).agg(F.bit_or(one).alias("bits")).toPandas()
    whole = np.zeros(bits >> 6, np.int64)
    whole[found["word"].to_numpy()] = found["bits"].to_numpy()
    return whole.view(np.uint64)


def _held(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets through."""
    own = hashes.view(np.uint64)
    step = (own >> np.uint64(33)) | np.uint64(1)
    held = np.ones(len(own), bool)
    for k in range(FILTER_HASHES):
        place = (own + step * np.uint64(k)) & np.uint64(len(filter_) * 64 - 1)
        held &= (filter_[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return held


class _Known(dict):
    """What a function gives for words or gaps seen before."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, piece: str):
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[piece] = self.function(piece)
        return found


class Walker:
    """Finds the runs of ``lengths`` words that the filter lets through, in many texts at once."""

    def __init__(self, filter_: np.ndarray, lengths: Sequence[int]):
        self.filter, self.lengths = filter_, frozenset(lengths)
        self.marks = _Known(lambda word: xxhash.xxh3_64_intdigest(word.lower()))
        self.gaps = _Known(lambda gap: bool(_GAP.fullmatch(gap)))

    def hits(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, int, int, str]]:
        """Text, start, end, hash and lower-case words of each run."""
        pieces: list[str] = []
        pairs = []
        for text in texts:
            # A gap and a word in turn; the last gap of a text has an empty word.
            own = [*_CUT.split(text), ""] if text else []
            pieces += own
            pairs.append(len(own) // 2)
        words, gaps = pieces[1::2], pieces[::2]
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        rows = np.repeat(np.arange(len(pairs)), pairs)
        before = np.cumsum([0, *(len(text or "") for text in texts)])[rows]
        starts, ends = ends[::2] - before, ends[1::2] - before
        marks = np.fromiter(map(self.marks.__getitem__, words), np.uint64, len(words))
        real = ends > starts
        joined = np.fromiter(map(self.gaps.__getitem__, gaps[1:]), bool, max(len(gaps) - 1, 0)) & real[:-1] & real[1:]
        first, value = np.flatnonzero(real), np.zeros(int(real.sum()), np.uint64)
        for count in range(1, max(self.lengths, default=0) + 1):
            if count > 1:
                on = first + count - 2 < len(joined)
                on[on] = joined[first[on] + count - 2]
                first, value = first[on], value[on]
            if not len(first):
                break
            value = value * np.uint64(_FACTOR) + marks[first + count - 1]
            if count in self.lengths:
                held = _held(self.filter, value)
                for at, hash_ in zip(first[held].tolist(), value[held].view(np.int64).tolist()):
                    run = " ".join(word.lower() for word in words[at : at + count])
                    yield int(rows[at]), int(starts[at]), int(ends[at + count - 1]), hash_, run


def find_names(
    df: DataFrame, names: DataFrame, text: str = "text", row_id: str = "id", name: str = "name",
    entity: str = "PERSON", score: float = SCORE,
) -> DataFrame:
    """Every occurrence of a name: the row's id, type, start, end, score and the text found."""
    known = materialize(hashed_names(names, name))  # read three times
    shape = {row["n_words"]: row["n"] for row in known.groupBy("n_words").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths = sorted(shape)
    bloom = df.sparkSession.sparkContext.broadcast(_filter_of(known, sum(shape.values())))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(bloom.value, lengths)
        for batch in batches:
            first = 0
            for piece in slices(batch.column(1), SLICE_BYTES):
                texts, keys = piece.to_pylist(), batch.column(0).slice(first, len(piece))
                hits = list(walker.hits(texts))
                rows, starts, ends, hashes, words = zip(*hits) if hits else ((),) * 5
                found = [texts[row][start:end] for row, start, end, _, _ in hits]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                     pa.array(hashes, pa.int64()), pa.array(words, pa.string()), pa.array(found, pa.string())],
                    names=["key", "start", "end", "hash", "words", "piece"],
                )
                first += len(piece)

    kind = df.schema[row_id].dataType.simpleString()
    runs = df.select(F.col(row_id).alias("key"), F.col(text).alias("value"))
    runs = runs.mapInArrow(walked, f"key {kind}, {HITS}, piece string")
    sure = runs.join(known.select("hash", "words"), ["hash", "words"])
    return sure.select(
        F.col("key").alias(row_id), F.lit(entity).alias("type"), "start", "end", F.lit(score).alias("score"), F.col("piece").alias("text"))


def _resolved(spans: pd.Series) -> pd.Series:
    out = []
    for own in spans:
        if own is None:
            out.append(None)
            continue
        by_place = {(s["type"], s["start"], s["end"], s["score"]): s["text"] for s in own}
        kept = resolve_overlaps(list(by_place))
        out.append([{"type": t, "start": a, "end": b, "score": s, "text": by_place[t, a, b, s]} for t, a, b, s in kept])
    return pd.Series(out, dtype="object")


def _without_overlaps(spans: Column) -> Column:
    return F.pandas_udf(_resolved, SPANS)(spans)


def merge_spans(spans: Column, more: Column) -> Column:
    """Two arrays of spans of one text as one without overlaps; only rows with both reach Python."""
    both = (F.size(spans) > 0) & (F.size(more) > 0)
    single = F.when(F.size(more) > 0, more).otherwise(spans)
    return F.coalesce(_without_overlaps(F.when(both, F.concat(spans, more))), single)


def name_spans(
    df: DataFrame, names: DataFrame, text: str, row_id: str = "id", name: str = "name", entity: str = "PERSON",
    score: float = SCORE,
) -> DataFrame:
    """The spans of names of each row that has some, without overlaps: ``row_id`` and ``spans``."""
    hits = find_names(df, names, text, row_id, name, entity, score)
    span = F.struct("type", "start", "end", "score", "text")
    return hits.groupBy(row_id).agg(F.collect_list(span).alias("spans")).select(row_id, _without_overlaps(F.col("spans")).alias("spans"))
