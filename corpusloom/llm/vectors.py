"""Operator 2: near-duplicate vectors by cross-polytope hashing.

A vector is set to length one, padded to a power of two and turned by three rounds of random signs
and a fast Hadamard transform; its hash is the signed axis it comes closest to.  ``k`` such hashes
make a bucket, with ``k`` so large that buckets outnumber the vectors eight times; ``TABLES``
tables are independent.  A vector lives in its home bucket and probes the buckets of its two best
axes per hash.  Vectors that meet in a bucket, one of them at home, are compared in double
precision, and the links of a bucket are reduced to those that join it.

All links lie within the components of these links, so the number of links of each vector is then
counted exactly within its component, in blocks of a bounded number of vectors.  Buckets and
components of any size are cut into blocks of rows by a hash, and every pair of blocks meets.

Equal vectors are one class with a weight, so copies cost nothing.  Null, empty or zero vectors,
vectors with null or non-finite components and rows without id link with nothing.  Vectors of
different lengths never link.  Repeated rows are copies of each other.  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import group_starts, join_parallelism, spanning, stored, whole_groups
from corpusloom.llm.graph import components

THRESHOLD = 0.95
TABLES = 6
ROUNDS = 3
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    half = 1
    while half < d:
        x = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        half *= 2
    return x / math.sqrt(d)


def hashes_for(count: int, dim: int) -> int:
    """Number of hashes per bucket for ``count`` vectors."""
    axes = 2 << max(0, math.ceil(math.log2(max(1, dim))))
    return max(1, math.ceil(math.log(8 * max(2, count)) / math.log(axes)))


def buckets(unit: np.ndarray, k: int, tables: int = TABLES) -> np.ndarray:
    """Bucket numbers, vectors x tables x 2^k; the first of each table is the home."""
    n, dim = unit.shape
    size = 1 << max(0, math.ceil(math.log2(max(1, dim))))
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    rows = np.arange(n)
    found = np.zeros((n, tables, 1 << k), np.int64)
    for t in range(tables):
        for h in range(k):
            random = np.random.default_rng([size, t, h])
            turned = padded
            for _ in range(ROUNDS):
                turned = hadamard(turned * random.choice([-1.0, 1.0], size))
            strength = np.abs(turned)
            best = strength.argmax(axis=1)
            axes = [best]
            strength[rows, best] = -1.0
            axes.append(strength.argmax(axis=1))
            axes = [2 * axis + (turned[rows, axis] < 0) for axis in axes]
            for probe in range(1 << k):
                found[:, t, probe] = found[:, t, probe] * (2 * size) + axes[probe >> h & 1]
    return found


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _classes(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, mark, vector): the mark is a digest of a usable vector, null for others."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, kept = batch.column(0), [], []
            for number, value in zip(ids, batch.column(1)):
                values = value.as_py()
                usable = number.as_py() is not None and values and None not in values
                if usable:
                    x = np.array(values, np.float64)
                    usable = np.isfinite(x).all() and x.any()
                if usable:
                    marks.append(hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest())
                    kept.append(x)
                else:
                    marks.append(None)
                    kept.append(None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(marks, pa.binary()), pa.array(kept, pa.list_(pa.float64()))],
                names=["vec_id", "mark", "vector"],
            )

    picked = vectors.select(F.col(id_column).cast("long"), F.col(vector_column).cast("array<double>"))
    return picked.mapInArrow(marked, "vec_id long, mark binary, vector array<double>")


def _blocks(rows: DataFrame, keys: list[str], size: Column, node: str) -> DataFrame:
    """Every row once per pair of blocks it belongs to: ``x`` <= ``y`` and the own block ``z``.

    A group of ``size`` rows has ``size / BLOCK`` blocks, so most have one and one row.
    """
    parts = F.greatest(F.lit(1), F.ceil(size / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64(node), F.col("_parts")).cast("int")
    laid = rows.withColumn("_parts", parts).withColumn("z", own)
    laid = laid.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    laid = laid.withColumn("x", F.least("z", "_other")).withColumn("y", F.greatest("z", "_other"))
    order = [*keys, "x", "y"]
    laid = laid.drop("_parts", "_other")
    spread = laid.repartition(join_parallelism(rows.sparkSession), *order)
    return spread.sortWithinPartitions(*order, "z", node)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaling first keeps very large and very small components exact."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _close_pairs(unit: np.ndarray, starts: np.ndarray, own: np.ndarray, cross: np.ndarray, threshold: float):
    """Pairs of close rows within each group.  ``own``: block of a row; ``cross``: only pairs of two blocks."""
    ends = np.append(starts[1:], len(unit))
    length = ends - starts
    group = np.repeat(np.arange(len(starts)), length)
    # Small groups: each row against the next ones, all groups at once.
    small = np.repeat(length <= 32, length)
    at = np.flatnonzero(small)
    lag = 1
    while len(at):
        at = at[at + lag < len(unit)]
        at = at[group[at] == group[np.minimum(at + lag, len(unit) - 1)]]
        if len(at):
            allowed = at[~cross[at] | (own[at] != own[at + lag])]
            near = np.einsum("ij,ij->i", unit[allowed], unit[allowed + lag]) >= threshold
            yield allowed[near], allowed[near] + lag
        lag += 1
    for one in np.flatnonzero(length > 32):
        first, last = starts[one], ends[one]
        for top in range(first, last, 512):
            bottom = min(top + 512, last)
            near = unit[top:bottom] @ unit[top:last].T >= threshold
            a, b = np.nonzero(near)
            a, b = a + top, b + top
            keep = (a < b) & (~cross[a] | (own[a] != own[b]))
            yield a[keep], b[keep]


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    threshold: float = THRESHOLD, tables: int = TABLES) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    marked = stored(_classes(vectors, id_column, vector_column), "vectors")
    usable = marked.where(F.col("mark").isNotNull())
    classes = usable.groupBy("mark").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    # One row of each class brings its vector; an id may have several vectors, so the class has a number.
    first = usable.join(classes, "mark").where("vec_id = rep").dropDuplicates(["mark"])
    reps = stored(first.select(F.xxhash64("mark").alias("node"), "mark", "rep", "weight", "vector",
                               F.size("vector").alias("dim")), "classes")
    nodes = reps.select("node", "vector", "dim")
    counts = {row["dim"]: row["n"] for row in reps.groupBy("dim").agg(F.count("*").alias("n")).toLocalIterator()}

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                for at in range(0, some.num_rows, 2000):
                    part = some.slice(at, 2000)
                    found = buckets(_unit(_matrix(part.column("vector"))), hashes_for(counts[int(dim)], int(dim)), tables)
                    n, _, probes = found.shape
                    table = np.broadcast_to(np.arange(tables)[None, :, None], found.shape)
                    home = np.broadcast_to(np.arange(probes) == 0, found.shape)
                    node = np.repeat(part.column("node").to_numpy(), tables * probes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(node.size, dim, np.int32)), pa.array(table.ravel().astype(np.int32)),
                         pa.array(found.ravel()), pa.array(node), pa.array(home.ravel())],
                        names=["dim", "t", "bucket", "node", "home"],
                    )

    schema = "dim int, t int, bucket long, node long, home boolean"
    probes = stored(nodes.mapInArrow(hashed, schema), "buckets")
    key = ["dim", "t", "bucket"]
    met = probes.groupBy(*key).agg(F.count("*").alias("n"), F.max("home").alias("lived_in"))
    met = met.where("n > 1 AND lived_in").drop("lived_in")
    rows = probes.drop("home").join(met, key).join(nodes.drop("dim"), "node")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, [*key, "x", "y"]):
            node = group.column("node").to_numpy()
            own, cross = group.column("z").to_numpy(), group.column("x").to_numpy() != group.column("y").to_numpy()
            starts = group_starts(group, [*key, "x", "y"])
            kept = []
            for first, last in _same_dim(group.column("dim").to_numpy(), starts):
                unit = _unit(_matrix(group.column("vector").slice(first, last - first)))
                inside = starts[(starts >= first) & (starts < last)] - first
                for a, b in _close_pairs(unit, inside, own[first:last], cross[first:last], threshold):
                    kept += spanning(zip(node[first + a].tolist(), node[first + b].tolist()))
            kept = spanning(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in kept], pa.int64()), pa.array([b for _, b in kept], pa.int64())],
                names=["a", "b"],
            )

    links = _blocks(rows, key, F.col("n"), "node").mapInArrow(linked, "a long, b long")
    found = stored(components(links), "components")
    sizes = found.groupBy("component").agg(F.count("*").alias("n"))
    members = found.join(sizes, "component").join(reps.select("node", "vector", "weight"), "node")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, ["component", "x", "y"]):
            node, weight = group.column("node").to_numpy(), group.column("weight").to_numpy()
            own, cross = group.column("z").to_numpy(), group.column("x").to_numpy() != group.column("y").to_numpy()
            starts = group_starts(group, ["component", "x", "y"])
            total = np.zeros(len(node), np.int64)
            dims = np.diff(group.column("vector").combine_chunks().offsets.to_numpy()) if len(node) else []
            for first, last in _same_dim(np.asarray(dims), starts):
                unit = _unit(_matrix(group.column("vector").slice(first, last - first)))
                inside = starts[(starts >= first) & (starts < last)] - first
                for a, b in _close_pairs(unit, inside, own[first:last], cross[first:last], threshold):
                    total[first : last] += np.bincount(a, weight[first + b], last - first).astype(np.int64)
                    total[first : last] += np.bincount(b, weight[first + a], last - first).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(total)], names=["node", "links"])

    links = _blocks(members, ["component"], F.col("n"), "node").mapInArrow(counted, "node long, links long")
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    # Names of components: the smallest id among their classes.
    named = found.join(reps.select("node", "rep"), "node")
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = reps.select("mark", "node", "rep", "weight").join(links, "node", "left")
    of_class = of_class.join(found, "node", "left").join(names, "component", "left").select(
        "mark",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    done = marked.select("vec_id", "mark").join(of_class, "mark", "left")
    component = F.coalesce("component_id", "vec_id")
    return done.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _same_dim(dims: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole groups whose vectors have the same length."""
    if not len(dims):
        return
    change = starts[1:][dims[starts[1:]] != dims[starts[1:] - 1]]
    bounds = [0, *change.tolist(), len(dims)]
    yield from zip(bounds[:-1], bounds[1:])
