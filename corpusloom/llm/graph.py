"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_IDS, bounded, spanning, stored


# A task contracts so many links without effort.
LINKS_PER_TASK = 100_000


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node it is linked with.

    First every task keeps those of its links that join something.  Then, in rounds, large star:
    every node tells its larger neighbours the smallest node it knows; small star: it tells its
    smaller ones.  The table never has more rows than it began with, ends as one star per component
    after a number of rounds logarithmic in the nodes, and no node's neighbours are ever gathered:
    there are minima by node, and joins with those, by broadcast where they are few.
    """
    edges = stored(_forest(links), "links")
    before = _fingerprint(edges)
    while before[0]:
        # As many tasks as the links need, however many partitions the session shuffles to.
        tasks = max(4, before[0] // LINKS_PER_TASK)
        edges = edges.coalesce(tasks)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).coalesce(tasks).where("_m < a")
        # A node that knows no smaller one is its own smallest.
        large = both.where("b > a").join(_few(least), "a", "left").select(
            F.col("b").alias("a"), F.coalesce("_m", "a").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("_m")).coalesce(tasks)
        pairs = F.array(F.struct(F.col("a"), F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))
        small = large.join(_few(least), "a").select(F.explode(pairs).alias("e")).select("e.a", "e.b")
        edges = stored(small.where("a != b").distinct().coalesce(tasks), "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    least = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(least)


def _few(least: DataFrame) -> DataFrame:
    least = stored(least, "least")
    return F.broadcast(least) if bounded(least, BROADCAST_IDS) else least


def _forest(links: DataFrame) -> DataFrame:
    """Of the links of each task, those that join two groups the ones before did not, larger node first."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for batch in batches:
            held += zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            if len(held) > 500_000:
                yield _as_batch(spanning(held))
                held = []
        yield _as_batch(spanning(held))

    return links.where("a != b").select("a", "b").mapInArrow(kept, "a long, b long").distinct()


def _as_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([max(link) for link in links], pa.int64()), pa.array([min(link) for link in links], pa.int64())],
        names=["a", "b"],
    )


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
