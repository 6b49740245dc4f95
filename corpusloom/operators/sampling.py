"""Seeded sampling, balancing, splitting and shuffling.

The order of a table is the order of ``md5(seed | id)``.  All operators only need the keys
found at a few ranks (see ``ranking``): ids and labels are read twice for those, whole rows
once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import seeded_key
from corpusloom.operators.ranking import (
    few_strata,
    keyed_rows,
    keys_at,
    numbered,
    stratum_sizes,
    take_per_stratum,
    with_limits,
)
from corpusloom.session import materialize


def balance_classes(
    df: DataFrame,
    label: str = "urgency_level",
    row_id: str = "id",
    target: int = K.SFT_TARGET_ROWS,
    levels: Sequence[str] = tuple(K.LEVELS),
    seed: int = K.SEED,
) -> DataFrame:
    """At most ``target // len(levels)`` rows of each known level; other labels are dropped."""
    share = target // len(levels)
    return take_per_stratum(df, row_id, F.col(label), share, seed, only=levels)


def stratified_sample(
    df: DataFrame,
    label: str = "urgency_level",
    row_id: str = "id",
    target: int = K.PAIR_TARGET_ROWS,
    seed: int = K.SEED,
) -> DataFrame:
    """At most ``target // k`` rows of each of the ``k`` labels that occur."""
    return take_per_stratum(df, row_id, F.col(label), lambda k: target // max(k, 1), seed)


def cap_sample(
    df: DataFrame,
    size: int,
    row_id: str = "id",
    seed: int = K.SEED,
) -> DataFrame:
    """``size`` rows in seeded order, or all rows when there are fewer.

    Not ``orderBy().limit()``, whose last step merges ``size`` rows of every partition in
    one task.
    """
    return take_per_stratum(df, row_id, F.lit("*"), size, seed, few=True)


def sample_per_group(
    df: DataFrame,
    group: Column,
    size: int,
    row_id: str = "id",
    seed: int = K.SEED,
) -> DataFrame:
    """``size`` rows of each group in seeded order."""
    return take_per_stratum(df, row_id, group, size, seed)


def shuffled(df: DataFrame, row_id: str = "id", seed: int = K.SEED) -> DataFrame:
    """The table in seeded order, for writing: range-partitioned and sorted by the key."""
    key = seeded_key(seed, F.col(row_id))
    return (
        df.withColumn("_key", key)
        .repartitionByRange("_key")
        .sortWithinPartitions("_key")
        .drop("_key")
    )


def _held_out(fraction: float, n: Column) -> Column:
    """Rows held out of ``n``: the fraction rounded up."""
    return F.ceil(F.lit(fraction) * n).cast("bigint")


def apportion(df: DataFrame, size: str, draws: Column, name: str) -> DataFrame:
    """Add a share of ``draws`` for each stratum in proportion to ``size``, by largest remainder.

    Ties go by stratum name.  ``df`` has one row per stratum, not per row, and few of them, so its
    windows are over all of it.
    """
    every = Window.partitionBy(F.lit(0))
    product = F.col(size).cast("decimal(19,0)") * F.col("_draws").cast("decimal(19,0)")
    total = F.greatest(F.sum(size).over(every), F.lit(1)).cast("decimal(19,0)")
    shared = df.withColumn("_draws", draws).withColumn("_total", total).withColumn(
        "_rest", product % F.col("_total")
    ).withColumn("_floor", ((product - F.col("_rest")) / F.col("_total")).cast("bigint"))
    spare = F.col("_draws") - F.sum("_floor").over(every)
    place = F.row_number().over(every.orderBy(F.col("_rest").desc(), "stratum"))
    share = F.col("_floor") + (place <= spare).cast("bigint")
    return shared.withColumn(name, share).drop("_draws", "_total", "_rest", "_floor")


def three_way_sizes(sizes: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1) -> DataFrame:
    """``(stratum, n, train, val)``: rows of each stratum in train and validation; test has the rest.

    Two successive splits: first everything into train and the rest, then the rest into
    validation and test.
    """
    test_ratio = 1.0 - train_ratio - val_ratio
    every = Window.partitionBy(F.lit(0))
    n = F.sum("n").over(every)
    parts = apportion(sizes, "n", n - _held_out(val_ratio + test_ratio, n), "train")
    parts = parts.withColumn("_left", F.col("n") - F.col("train"))
    left = F.sum("_left").over(every)
    draws = left - _held_out(test_ratio / (val_ratio + test_ratio), left)
    return apportion(parts, "_left", draws, "val").drop("_left")


def apportion_many(df: DataFrame, size: str, draws: int, name: str) -> DataFrame:
    """As ``apportion`` for any number of strata: their order of remainders is cut into ranges."""
    total = max(df.agg(F.sum(size)).first()[0] or 0, 1)
    whole = F.lit(total).cast("decimal(19,0)")
    product = F.col(size).cast("decimal(19,0)") * F.lit(draws).cast("decimal(19,0)")
    shared = df.withColumn("_rest", product % whole).withColumn(
        "_floor", ((product - F.col("_rest")) / whole).cast("bigint"))
    placed = numbered(shared, [F.col("_rest").desc(), F.col("stratum")], "_place")
    spare = draws - (placed.agg(F.sum("_floor")).first()[0] or 0)
    share = F.col("_floor") + (F.col("_place") <= spare).cast("bigint")
    return placed.withColumn(name, share).drop("_rest", "_floor", "_place")


def three_way_sizes_many(sizes: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1) -> DataFrame:
    """As ``three_way_sizes`` for any number of strata; runs jobs over the table of sizes."""
    test_ratio = 1.0 - train_ratio - val_ratio
    sizes = materialize(sizes)
    n = sizes.agg(F.sum("n")).first()[0] or 0
    held = math.ceil((val_ratio + test_ratio) * n)
    parts = apportion_many(sizes, "n", n - held, "train").withColumn("_left", F.col("n") - F.col("train"))
    draws = held - math.ceil(test_ratio / (val_ratio + test_ratio) * held)
    return apportion_many(parts, "_left", draws, "val").drop("_left")


def stratified_split(
    df: DataFrame,
    label: str = "urgency_level",
    row_id: str = "id",
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    seed: int = K.SEED,
    few: bool | None = None,
) -> DataFrame:
    """Add ``split``: train, val or test, in the same proportions within every label.

    ``few`` says whether the labels are few enough for one task and a broadcast; it is checked
    where it is not given, and changes no result.
    """
    stratum, key = F.col(label), seeded_key(seed, F.col(row_id))
    keyed = keyed_rows(df, stratum, key)
    few = few_strata(keyed) if few is None else few
    shared = three_way_sizes if few else three_way_sizes_many
    shares = shared(stratum_sizes(keyed), train_ratio, val_ratio)
    last = F.array(
        F.struct(F.lit("train").alias("cut"), F.col("train").alias("rank")),
        F.struct(F.lit("val").alias("cut"), (F.col("train") + F.col("val")).alias("rank")),
    )
    found = keys_at(keyed, shares.select("stratum", F.inline(last)))
    limited = with_limits(df, found, ["train", "val"], stratum, key, few)
    split = F.when(F.col("_key") <= F.col("_upto_train"), "train").when(F.col("_key") <= F.col("_upto_val"), "val")
    return limited.select(*df.columns, split.otherwise("test").alias("split"))


def random_split(
    df: DataFrame,
    row_id: str = "id",
    train_ratio: float = 0.9,
    seed: int = K.SEED,
) -> DataFrame:
    """Add ``split``: train or val, with exact sizes."""
    stratum, key = F.lit("*"), seeded_key(seed, F.col(row_id))
    keyed = keyed_rows(df, stratum, key)
    train = F.col("n") - _held_out(1.0 - train_ratio, F.col("n"))
    ranks = stratum_sizes(keyed).select("stratum", F.lit("train").alias("cut"), train.alias("rank"))
    limited = with_limits(df, keys_at(keyed, ranks), ["train"], stratum, key, True)
    split = F.when(F.col("_key") <= F.col("_upto_train"), "train").otherwise("val")
    return limited.select(*df.columns, split.alias("split"))
