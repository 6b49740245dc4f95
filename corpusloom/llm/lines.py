"""Operator 8: reversible line deduplication by reference counts and sharded cuckoo filters.

The state is two tables.  ``refcounts`` is exact: 128-bit digest of a line key -> number of
documents that hold the line.  ``filters`` has one cuckoo filter per shard, holding the keys
whose count reaches the threshold.  Inserting documents adds their counts, deleting them
subtracts; the filters then receive and lose just the keys that crossed the threshold, which a
cuckoo filter can do and a Bloom filter cannot.  A line is dropped if the filter of its shard
holds it and the exact table confirms it.

Rows are documents: a repeated row counts again.  A null or empty text is one empty line, whose
key has no code points and is never dropped.  An empty table gives an empty state.  Other columns
of the input pass through, but for those named ``kept_text``, ``n_lines`` or ``n_dropped``, which give
way to the results.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded, fresh, new_folder

BLANKS = b" \t\n\x0b\x0c\r"
MIN_CHARS = 1
MIN_DOCS = 10
SHARDS = 64
SLOTS = 4
# Up to so many dropped keys (16 bytes each, and a filter of 3) go to the tasks as a broadcast;
# more are joined by key.
BROADCAST_KEYS = 2_000_000

COUNTS = "key binary, n_docs long"
FILTERS = "shard int, buckets binary"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of the stripped, lower-cased line, or None if it has too few code points."""
    plain = line.strip(BLANKS).lower()
    if len(plain) < min_chars or (min_chars > 1 and len(plain.decode()) < min_chars):
        return None
    return hashlib.blake2b(plain, digest_size=16).digest()


class CuckooFilter:
    """Sixteen-bit fingerprints in buckets of four; each key has two buckets.

    Grows by doubling when an insertion finds no place, so it never loses a key.  As fingerprints
    do not tell the key, growing starts from the exact keys; the caller passes them.
    """

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        size = 1 << max(1, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * 0.8)))))
        while True:
            made = cls(np.zeros((size, SLOTS), np.uint16))
            if all(made.insert(key) for key in keys):
                return made
            size *= 2

    @classmethod
    def read(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.buckets.tobytes()

    def places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "little") or 1
        mask = len(self.buckets) - 1
        home = int.from_bytes(key[:8], "little") & mask
        return mark, home, (home ^ (mark * 0x5BD1E995)) & mask

    def insert(self, key: bytes) -> bool:
        mark, home, other = self.places(key)
        mask = len(self.buckets) - 1
        for at in (home, other):
            free = np.flatnonzero(self.buckets[at] == 0)
            if len(free):
                self.buckets[at, free[0]] = mark
                return True
        at = home
        for step in range(500):
            slot = step % SLOTS
            mark, self.buckets[at, slot] = int(self.buckets[at, slot]), mark
            at = (at ^ (mark * 0x5BD1E995)) & mask
            free = np.flatnonzero(self.buckets[at] == 0)
            if len(free):
                self.buckets[at, free[0]] = mark
                return True
        return False

    def delete(self, key: bytes) -> bool:
        mark, home, other = self.places(key)
        for at in (home, other):
            held = np.flatnonzero(self.buckets[at] == mark)
            if len(held):
                self.buckets[at, held[0]] = 0
                return True
        return False

    def holds(self, key: bytes) -> bool:
        mark, home, other = self.places(key)
        return mark in self.buckets[home] or mark in self.buckets[other]


def shard_of(key: bytes, shards: int = SHARDS) -> int:
    return zlib.crc32(key) % shards


def count_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Number of documents per line key; each task sums its own rows before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text"):
                lines = (text.as_py() or "").encode().split(b"\n")
                seen.update({key for line in lines if (key := line_key(line, min_chars))})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                names=["key", "n_docs"],
            )

    return (
        docs.select("text").mapInArrow(counted, COUNTS)
        .groupBy("key").agg(F.sum("n_docs").alias("n_docs"))
    )


class LineIndex:
    """Versions of the two state tables in a folder; each change writes the next version.

    ``insert`` and ``delete`` return the index of the new version; the old one stays readable, so
    a failed job is repeated from it.
    """

    def __init__(self, spark: SparkSession, folder: str, version: int = 0,
                 min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shards: int = SHARDS):
        self.spark, self.folder, self.version = spark, folder, version
        self.min_docs, self.min_chars, self.shards = min_docs, min_chars, shards

    def _path(self, name: str) -> str:
        return os.path.join(self.folder, f"v{self.version:06d}", name)

    def refcounts(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(self._path("refcounts"))

    def filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], FILTERS)
        return self.spark.read.schema(FILTERS).parquet(self._path("filters"))

    def repeated(self) -> DataFrame:
        """Keys whose lines are dropped."""
        return self.refcounts().where(F.col("n_docs") >= self.min_docs).select("key")

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        after = LineIndex(self.spark, self.folder, self.version + 1, self.min_docs, self.min_chars, self.shards)
        change = count_lines(docs, self.min_chars).select("key", (sign * F.col("n_docs")).alias("n_docs"))
        whole = change
        if self.version:
            whole = self.refcounts().unionByName(change).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))
        whole.where("n_docs > 0").write.mode("overwrite").parquet(after._path("refcounts"))
        after._write_filters(self)
        return after

    def _write_filters(self, before: LineIndex) -> None:
        """Filters of this version: those of the one before, less and plus the keys that crossed."""
        now = self.repeated().withColumn("now", F.lit(True))
        was = before.repeated().withColumn("was", F.lit(True))
        keys = now.join(was, "key", "full_outer").withColumn("shard", (F.crc32("key") % self.shards).cast("int"))

        def updated(key: tuple, changed: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            keep = changed["now"].notna()
            wanted = [bytes(k) for k in changed.loc[keep, "key"]]
            if len(old):
                held = CuckooFilter.read(old["buckets"].iloc[0])
                gone = changed.loc[~keep & changed["was"].notna(), "key"]
                new = changed.loc[keep & changed["was"].isna(), "key"]
                done = all([held.delete(bytes(k)) for k in gone]) and all(held.insert(bytes(k)) for k in new)
            else:
                done = False
            if not done:
                held = CuckooFilter.of(wanted)
            return pd.DataFrame({"shard": [key[0]], "buckets": [held.to_bytes()]})

        made = keys.groupBy("shard").cogroup(before.filters().groupBy("shard")).applyInPandas(updated, FILTERS)
        made.write.mode("overwrite").parquet(self._path("filters"))

    def apply(self, docs: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
        """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``; input columns so named give way to them."""
        docs = docs.drop("kept_text", "n_lines", "n_dropped")
        if bounded(self.repeated(), broadcast_keys):
            return _drop_by_broadcast(docs, self)
        return _drop_by_join(docs, self)


def _added(batch: pa.RecordBatch, kept: list, counts: list, dropped: list) -> pa.RecordBatch:
    columns = [*batch.columns, pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "kept_text", "n_lines", "n_dropped"])


def _result_schema(docs: DataFrame):
    plain = docs.select("*", F.lit("").alias("kept_text"), F.lit(0).cast("long").alias("n_lines"),
                        F.lit(0).cast("long").alias("n_dropped"))
    return plain.schema


def _drop_by_broadcast(docs: DataFrame, index: LineIndex) -> DataFrame:
    """The filters and the confirmed keys go to every task; one pass over the texts, no shuffle."""
    filters = {row["shard"]: bytes(row["buckets"]) for row in index.filters().toLocalIterator()}
    exact = frozenset(bytes(row["key"]) for row in index.repeated().toLocalIterator())
    state = docs.sparkSession.sparkContext.broadcast((filters, exact))
    shards, min_chars = index.shards, index.min_chars

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, confirmed = state.value
        held = {shard: CuckooFilter.read(blob) for shard, blob in blobs.items()}
        known: dict[bytes, bool] = {}

        def gone(line: bytes) -> bool:
            key = line_key(line, min_chars)
            if key is None:
                return False
            if key not in known:
                if len(known) > 200_000:
                    known.clear()
                shard = held.get(shard_of(key, shards))
                known[key] = shard is not None and shard.holds(key) and key in confirmed
            return known[key]

        for batch in batches:
            kept, counts, dropped = [], [], []
            for text in batch.column("text"):
                lines = (text.as_py() or "").encode().split(b"\n")
                stay = [line for line in lines if not gone(line)]
                kept.append(b"\n".join(stay).decode())
                counts.append(len(lines))
                dropped.append(len(lines) - len(stay))
            yield _added(batch, kept, counts, dropped)

    return docs.mapInArrow(mapped, _result_schema(docs))


def _drop_by_join(docs: DataFrame, index: LineIndex) -> DataFrame:
    """Beyond the broadcast: line digests meet the exact table by key, and return to their document.

    Only digests are shuffled by key; a key of very many documents is one that AQE can split.
    Documents are known by id and digest of the text, so repeated rows share their answer.
    """
    min_chars = index.min_chars

    @F.udf("array<binary>")
    def keys_of(text):
        return list({k for line in (text or "").encode().split(b"\n") if (k := line_key(line, min_chars))})

    @F.udf("struct<kept_text:string,n_lines:long,n_dropped:long>")
    def without(text, keys):
        drop = {bytes(k) for k in keys or ()}
        lines = (text or "").encode().split(b"\n")
        stay = [line for line in lines if line_key(line, min_chars) not in drop]
        return b"\n".join(stay).decode(), len(lines), len(lines) - len(stay)

    mark = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    lines = docs.select(mark.alias("mark"), "text").select("mark", F.explode(keys_of("text")).alias("key")).distinct()
    hits = lines.join(index.repeated(), "key").groupBy("mark").agg(F.collect_list("key").alias("keys"))
    hits = hits.withColumnRenamed("mark", "_mark").withColumnRenamed("keys", "_keys")
    joined = docs.join(hits, mark == hits["_mark"], "left")
    done = fresh("_done", docs)
    made = joined.select(*[docs[c] for c in docs.columns], without(docs["text"], hits["_keys"]).alias(done))
    return made.select(*docs.columns, *[f"{done}.{c}" for c in ("kept_text", "n_lines", "n_dropped")])


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                folder: str | None = None) -> DataFrame:
    """Build an index of ``docs`` and drop their repeated lines."""
    spark = docs.sparkSession
    index = LineIndex(spark, folder or new_folder(spark, "lines"), min_docs=min_docs, min_chars=min_chars)
    return index.insert(docs).apply(docs)
