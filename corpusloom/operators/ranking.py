"""Exact order statistics without sorting a table by group.

``row_number() over (partition by class order by key)`` puts a three-class table on three
tasks.  What the sampling and splitting operators need is less than a rank: only the key
found *at* a few given ranks.  With those limits in hand every row decides alone on which
side of a limit it lies.

The limits are found by one plan for every size: a histogram over the first digits of the
key says which bucket of a stratum holds a rank, and that bucket alone is ordered.  They stay
a table of one row per stratum, which is joined to the rows: by broadcast where the number of
strata is known or checked to be small, else by stratum and, for the large strata, a salt, so that
a stratum of any size is spread and a small one is not multiplied.  Building a frame starts no job
but that check.  A few rows of each of many strata are taken by rank, for which every task sends no
more than those few.

``numbered`` gives every row its place in one order of the whole table, for tables of distinct keys.

``value_cuts`` does the same for arbitrary numbers, from approximate quantiles that bracket
the exact ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import seeded_key
from corpusloom.session import materialize

# Hex digits of the key that name a bucket: up to 65 536 buckets per stratum.
DIGITS = 4
# Limits of up to so many strata (some 100 bytes each) may be broadcast.
BROADCAST_STRATA = 100_000
# Parts into which the rows of a large stratum are spread beyond that, and its least size: of all
# rows at most one in so many stands for a large stratum, and those few are broadcast.
SALTS = 64
LARGE = 1_000_000
# Ranks up to which Spark limits the rows of a group before they are shuffled.
RANK_LIMIT = 1000


def stratum_of(label: Column) -> Column:
    """A label as stratum name; null is a stratum like any other."""
    return F.coalesce(label.cast("string"), F.lit(""))


def keyed_rows(df: DataFrame, stratum: Column, key: Column) -> DataFrame:
    """``(stratum, key)`` of every row."""
    return df.select(stratum_of(stratum).alias("stratum"), key.alias("key"))


def few_strata(keyed: DataFrame) -> bool:
    """Whether the strata are few enough for a broadcast; counts no further than that."""
    return keyed.select("stratum").distinct().limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the place of every row, from 1, in ``order``, which tells all rows apart.

    The table is cut into ranges of that order and stored once with the number of each range;
    places within a range are counted in its own task, and the rows of all ranges before it, one
    number per range, are added.  No task sees more than a range.
    """
    laid = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts, before, done = laid.groupBy("_range").count().collect(), [], 0
    for row in sorted(counts):
        before.append((row["_range"], done))
        done += row["count"]
    offsets = df.sparkSession.createDataFrame(before, "_range int, _before long")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = laid.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + inside)
    return placed.drop("_range", "_before")


def large_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys of more than ``LARGE`` rows, marked."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.where(F.col("_n") > LARGE).select(key, F.lit(True).alias("_large"))


def spread(table: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """One row per key and salt: all salts for a large key, 0 for any other."""
    salts = F.when(F.col("_large"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return table.join(F.broadcast(large), key, "left").withColumn("_salt", F.explode(salts)).drop("_large")


def _salted(df: DataFrame, table: DataFrame, key: str, dealt: Column) -> DataFrame:
    """``df`` left-joined with ``table`` by key and salt; ``dealt`` deals out the rows of large keys, and those of none."""
    large = large_keys(df, key)
    salt = F.when(F.col("_large") | F.col(key).isNull(), F.pmod(dealt, F.lit(SALTS)).cast("int")).otherwise(0)
    rows = df.join(F.broadcast(large), key, "left").withColumn("_salt", salt).drop("_large")
    return rows.join(spread(table, large, key), [key, "_salt"], "left").drop("_salt")


def salted_join(df: DataFrame, table: DataFrame, key: str, few: bool) -> DataFrame:
    """``df`` left-joined with ``table``, which has one row per ``key``: by broadcast, or by key and salt."""
    if few:
        return df.join(F.broadcast(table), key, "left")
    hashed = [F.col(c) for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    return _salted(df, table, key, F.xxhash64(*hashed))


def stratum_sizes(keyed: DataFrame) -> DataFrame:
    """``(stratum, n)``."""
    return keyed.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))


def keys_at(keyed: DataFrame, ranks: DataFrame) -> DataFrame:
    """The key at a 1-based rank of a stratum: ``(stratum, cut, key)``.

    ``ranks`` is ``(stratum, cut, rank)``; keys are unique uniform hex digests.  Ranks beyond
    the size of the stratum mean its last key, ranks below 1 nothing.
    """
    bucket = F.substring("key", 1, DIGITS)
    counts = keyed.groupBy("stratum", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    running, whole = Window.partitionBy("stratum").orderBy("bucket"), Window.partitionBy("stratum")
    placed = counts.withColumn("upto", F.sum("n").over(running)).withColumn("size", F.sum("n").over(whole))
    before, rank = F.col("upto") - F.col("n"), F.least("rank", "size")
    edges = (
        placed.join(ranks, "stratum")
        .where((rank > before) & (rank <= F.col("upto")))
        .select("stratum", "cut", "bucket", (rank - before).alias("place"))
    )
    inside = Window.partitionBy("stratum", "cut", "bucket").orderBy("key")
    return (
        keyed.withColumn("bucket", bucket)
        .join(edges, ["stratum", "bucket"])
        .withColumn("at", F.row_number().over(inside))
        .where(F.col("at") == F.col("place"))
        .select("stratum", "cut", "key")
    )


def with_limits(
    df: DataFrame, found: DataFrame, cuts: Sequence[str], stratum: Column, key: Column, few: bool
) -> DataFrame:
    """``df`` with ``_key`` and, per cut, ``_upto_<cut>``: the limit of the row's stratum, or null."""
    limits = found.groupBy(F.col("stratum").alias("_stratum")).agg(
        *[F.max(F.when(F.col("cut") == c, F.col("key"))).alias(f"_upto_{c}") for c in cuts]
    )
    rows = df.withColumn("_key", key).withColumn("_stratum", stratum_of(stratum))
    if few:
        return rows.join(F.broadcast(limits), "_stratum", "left").drop("_stratum")
    return _salted(rows, limits, "_stratum", F.xxhash64("_key")).drop("_stratum")


def take_per_stratum(
    df: DataFrame,
    row_id: str,
    stratum: Column,
    quota: int | Callable[[int], int],
    seed: int,
    only: Sequence[str] | None = None,
    few: bool | None = None,
) -> DataFrame:
    """Keep the first ``quota`` rows of each stratum in seeded order.

    ``quota`` may depend on the number of strata.  ``only`` names the strata to keep at all,
    ``few`` says that strata are few by construction.
    """
    key = seeded_key(seed, F.col(row_id))
    rows = df if only is None else df.where(stratum_of(stratum).isin(list(only)))
    keyed = keyed_rows(rows, stratum, key)
    few = few_strata(keyed) if few is None and only is None else True if few is None else few
    size = quota(keyed.select("stratum").distinct().count()) if callable(quota) else quota
    if size <= 0:
        return df.where(F.lit(False))
    if not few and size <= RANK_LIMIT:
        # The rank counts the smaller keys, so rows of one key stay or go together, as by a limit.
        order = Window.partitionBy("_stratum").orderBy("_key")
        placed = rows.withColumn("_stratum", stratum_of(stratum)).withColumn("_key", F.unhex(key))
        return placed.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= size).select(*df.columns)
    ranks = keyed.select("stratum").distinct().select("stratum", F.lit("take").alias("cut"), F.lit(size).alias("rank"))
    found = keys_at(keyed, ranks)
    limited = with_limits(rows, found, ["take"], stratum, key, few)
    return limited.where(F.col("_key") <= F.col("_upto_take")).select(*df.columns)


@dataclass(frozen=True)
class ValueCut:
    """One order statistic: about the fraction ``near``, exactly the 0-based ``rank(n)``."""

    name: str
    near: float
    rank: Callable[[Column], Column]


# Steps into which a bracket is cut, so that no task orders a whole bracket.
BRACKET_STEPS = 1000


def value_cuts(
    df: DataFrame,
    stratum: Column,
    value: Column,
    cuts: Sequence[ValueCut],
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact order statistics of a number per stratum, as ``(stratum, cut, value)``.

    Two scans, none of which gathers or sorts a stratum: (1) sizes and, per cut, two
    approximate quantiles whose error bound (``n / accuracy`` ranks) places the exact value
    between them; (2) one aggregation that counts the rows between brackets and the distinct
    values inside them.  Running sums then go over the steps of the brackets and over the
    values of one step.  A bracket that missed would fail, not mislead.
    """
    data = df.select(stratum_of(stratum).alias("stratum"), value.cast("double").alias("v")).where(
        F.col("v").isNotNull()
    )
    slack = 2.0 / accuracy
    fractions = [
        F.lit(f)
        for cut in cuts
        for f in (max(cut.near - slack, 0.0), min(cut.near + slack, 1.0))
    ]
    digest = data.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("size"),
        F.percentile_approx("v", F.array(*fractions), accuracy).alias("q"),
    )
    # Brackets may overlap; a value's zone is the number of bracket ends below it.
    lows = [F.get("q", F.lit(2 * i)) for i in range(len(cuts))]
    highs = [F.get("q", F.lit(2 * i + 1)) for i in range(len(cuts))]
    v = F.col("v")
    zone, inside, low, high = F.lit(0), F.lit(False), F.lit(None).cast("double"), F.lit(None).cast("double")
    for a, b in zip(lows, highs):
        zone = zone + (v >= a).cast("int") + (v > b).cast("int")
        here = (v >= a) & (v <= b)
        inside, low, high = inside | here, F.when(here, a).otherwise(low), F.when(here, b).otherwise(high)
    step = F.when(high > low, F.floor((v - low) / (high - low) * BRACKET_STEPS)).otherwise(0)
    few = few_strata(data)
    bounds = F.broadcast(digest) if few else digest
    laid = data.join(bounds, "stratum").select(
        "stratum", "size", zone.alias("zone"), F.when(inside, step).otherwise(-1).cast("int").alias("step"),
        F.when(inside, v).alias("v"),
    )
    counted = laid.groupBy("stratum", "size", "zone", "step", "v").agg(F.count(F.lit(1)).alias("n"))
    steps = counted.groupBy("stratum", "zone", "step").agg(
        F.sum("n").alias("n"), F.min(F.coalesce("v", F.lit(float("-inf")))).alias("first"))
    order = Window.partitionBy("stratum").orderBy("zone", "first")
    before = steps.withColumn("before", F.sum("n").over(order) - F.col("n")).drop("n", "first")
    running = Window.partitionBy("stratum", "zone", "step").orderBy(F.col("v").asc_nulls_first())
    placed = counted.join(before, ["stratum", "zone", "step"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(running)
    )
    ranks = F.explode(F.array(*[
        F.struct(F.lit(cut.name).alias("cut"), cut.rank(F.col("size")).cast("bigint").alias("rank")) for cut in cuts
    ]))
    missed = F.raise_error(F.lit("quantile bracket missed its value"))
    return (
        placed.select("stratum", "v", "n", "upto", ranks.alias("at"))
        .where((F.col("at.rank") < F.col("upto")) & (F.col("at.rank") >= F.col("upto") - F.col("n")))
        .select("stratum", "at.cut", F.when(F.col("v").isNull(), missed).otherwise(F.col("v")).alias("value"))
    )
