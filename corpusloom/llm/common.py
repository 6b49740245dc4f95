"""Helpers shared by the operators: stored intermediate tables, text cut into batches, held-out rows."""

from __future__ import annotations

import ctypes
import gc
import itertools
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import shared_folder

# Lists of up to so many rows of ids (16 bytes each) may be sent to every task; longer ones are shuffled.
BROADCAST_IDS = 500_000


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder; nothing is created yet."""
    app = spark.sparkContext.applicationId
    return os.path.join(shared_folder(spark), "corpusloom", app, f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files, which outlive executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """Python's search for reference cycles off, for a task that remembers much and makes none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def returning(step: Callable) -> Callable:
    """A step of ``mapInArrow`` that gives its task's memory back to the system when the task ends.

    Workers live on through the stages of a job; what their allocators keep would add up.
    """

    def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return stepped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept away from training: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def join_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows, found without counting further than that."""
    return df.limit(limit + 1).count() <= limit


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, or the first of ``name_1``, ``name_2``... that is no column of ``tables``, in any case of letters."""
    taken = {column.lower() for df in tables for column in df.columns}
    names = itertools.chain([name], (f"{name}_{k}" for k in itertools.count(1)))
    return next(one for one in names if one.lower() not in taken)


def sampled(rows: DataFrame, limit: int, by: str | None = None) -> DataFrame:
    """At most ``limit`` ids of each value of ``by``, or of all rows, chosen by a hash of ``doc_id``.

    ``rows`` has ``doc_id`` and perhaps other columns, none null; equal rows count once.  Rows are
    thinned by their hash to about four times the limit before they are made distinct and ranked,
    so the ranking of a value that has most of the rows is as small as any, however often its rows
    are repeated.  The numbers of ids are estimates; they only steer the thinning, whose margin is
    far beyond their error.
    """
    laid = rows.withColumn("_place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    ids, wide = F.approx_count_distinct("doc_id"), (1 << 40) * (4.0 * limit + 100)
    if by is None:
        share = wide / max(1, rows.agg(ids).first()[0])
        return laid.where(F.col("_place") < share).distinct().orderBy("_place", "doc_id").limit(limit).drop("_place")
    size = stored(rows.groupBy(by).agg(ids.alias("_n")), "sizes")
    if bounded(size, BROADCAST_IDS):
        size = F.broadcast(size)
    thin = laid.join(size, by).where(F.col("_place") < wide / F.col("_n")).select(*laid.columns).distinct()
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_place", "doc_id"))
    return thin.withColumn("_rank", rank).where(F.col("_rank") <= limit).select(*rows.columns)


def without(docs: DataFrame, removed: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` without the rows of ``removed(doc_id, mark)``, the mark being the hash of a text.

    Null-safe in the id.  Texts move only if the list is longer than ``limit``.
    """
    removed = stored(removed.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "removed")
    if bounded(removed, limit):
        removed = F.broadcast(removed)
    same = docs["doc_id"].eqNullSafe(removed["_id"]) & (F.xxhash64(docs["text"]) == removed["_mark"])
    return docs.join(removed, same, "left_anti")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with nulls as empty strings."""
    return batch.column(column).fill_null("")


def byte_slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``limit`` bytes.

    Yields (first row, row after the last, bytes of the run, offsets into them).  A longer
    text is a run of its own; nothing is cut within a text.
    """
    if not len(texts):
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, whole[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by integer ``keys``; a group never ends in the middle."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = group_starts(batch, keys)
        if waiting and _same_group(waiting[-1], batch, keys):
            if len(starts) == 1:
                waiting.append(batch)
                continue
            cut = int(starts[1])
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)]).combine_chunks()
            batch = batch.slice(cut)
            starts = starts[1:] - cut
        elif waiting:
            yield pa.Table.from_batches(waiting).combine_chunks()
        last = int(starts[-1])
        if last:
            yield pa.Table.from_batches([batch.slice(0, last)])
        waiting = [batch.slice(last)]
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _same_group(left: pa.RecordBatch, right: pa.RecordBatch, keys: list[str]) -> bool:
    return all(left.column(k)[left.num_rows - 1].as_py() == right.column(k)[0].as_py() for k in keys)


def group_starts(rows: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each run of equal keys."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = rows.column(key).to_numpy() if isinstance(rows, pa.Table) else rows.column(key).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def spanning(links: Iterator[tuple[int, int]] | list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of ``links``, those that join two groups not joined by the ones before."""
    head: dict[int, int] = {}

    def root(x: int) -> int:
        while head.setdefault(x, x) != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    kept = []
    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            head[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept
