"""Ranking, sampling, splitting, pairs and gates."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import render_answer
from corpusloom.functions.text import seeded_key
from corpusloom.operators import gates, pairs, ranking, sampling


def key(i, seed=42):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def classes(spark):
    """3000 rows; one class holds most of them, one row has no class."""
    label = F.when(F.col("id") == 7, None).when(F.col("id") % 10 == 0, "max").when(
        F.col("id") % 10 < 3, "deferred").otherwise("moderate")
    return spark.range(3000).select("id", label.alias("urgency_level")).repartition(6).cache()


def by_class(df):
    groups = defaultdict(list)
    for i, level in df.collect():
        groups[level].append(i)
    return {level: sorted(ids, key=key) for level, ids in groups.items()}


@pytest.fixture(params=["broadcast limits", "salted limits", "coarse buckets"])
def way(request, monkeypatch):
    """Every sampling test runs with limits broadcast, joined by a salt, and with few buckets."""
    if request.param == "salted limits":
        monkeypatch.setattr(ranking, "BROADCAST_STRATA", 0)
    if request.param == "coarse buckets":
        monkeypatch.setattr(ranking, "DIGITS", 1)
    return request.param


def test_balance(classes, way):
    ranked = by_class(classes)
    got = {r.id for r in sampling.balance_classes(classes, target=1500).collect()}
    assert got == {i for level in K.LEVELS for i in ranked[level][:500]}


def test_stratified_sample_counts_the_classes_present(classes, way):
    known = classes.where(F.col("urgency_level").isin("max", "deferred"))
    ranked = by_class(known)
    got = {r.id for r in sampling.stratified_sample(known, target=401).collect()}
    assert got == {i for level in ranked for i in ranked[level][:200]}


def test_cap(classes, way):
    ids = sorted(range(3000), key=key)
    for size in (0, 1, 100, 2999, 3000, 9000):
        assert {r.id for r in sampling.cap_sample(classes, size).collect()} == set(ids[:size])


def apportioned(sizes, draws):
    """Shares of ``draws`` by largest remainder, ties by name."""
    total = max(sum(sizes.values()), 1)
    shares = {s: n * draws // total for s, n in sizes.items()}
    order = sorted(sizes, key=lambda s: (-(sizes[s] * draws % total), s))
    for s in order[: draws - sum(shares.values())]:
        shares[s] += 1
    return shares


def three_way(sizes, train_ratio=0.8, val_ratio=0.1):
    test_ratio = 1.0 - train_ratio - val_ratio
    n = sum(sizes.values())
    train = apportioned(sizes, n - math.ceil((val_ratio + test_ratio) * n))
    rest = {s: sizes[s] - train[s] for s in sizes}
    left = sum(rest.values())
    val = apportioned(rest, left - math.ceil(test_ratio / (val_ratio + test_ratio) * left))
    return {s: (train[s], val[s]) for s in sizes}


@pytest.mark.parametrize("sizes", [
    {"a": 1894, "b": 1894, "c": 1893}, {"a": 5, "b": 3}, {"a": 1}, {"a": 7, "b": 0}, {"x": 5681},
    {f"s{k}": k * 37 % 11 for k in range(40)}, {"a": 3 * 10**11, "b": 10**11 + 7},
])
def test_three_way_sizes(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "stratum string, n bigint")
    got = {r.stratum: (r.train, r.val) for r in sampling.three_way_sizes(table).collect()}
    assert got == three_way(sizes)
    many = {r.stratum: (r.train, r.val) for r in sampling.three_way_sizes_many(table).collect()}
    assert many == got


def test_sizes_of_no_strata(spark):
    assert sampling.three_way_sizes_many(spark.createDataFrame([], "stratum string, n bigint")).collect() == []


def test_split_of_many_strata_orders_no_table_in_one_task(spark):
    rows = spark.range(900).select("id", (F.col("id") % 301).cast("string").alias("urgency_level"))
    few, many = (sampling.stratified_split(rows, few=few) for few in (True, False))
    assert sorted(few.collect()) == sorted(many.collect())
    plan = many._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "SinglePartition" not in plan and "SinglePartition" in few._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_numbered(spark):
    """Places in a total order, descending first, over more ranges than rows and over ties of the first column."""
    rows = [(k % 7, f"n{k:03}") for k in range(500)]
    expected = {row: at for at, row in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1)}
    table = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = ranking.numbered(table, [F.col("a").desc(), F.col("b")], "place")
    assert got.columns == ["a", "b", "place"] and {(r.a, r.b): r.place for r in got.collect()} == expected
    assert ranking.numbered(table.limit(0), [F.col("a"), F.col("b")], "place").count() == 0


def test_sizes_of_published_splits():
    assert three_way({"x": 5681})["x"] == (4544, 568)
    assert 957 - math.ceil((1.0 - 0.9) * 957) == 861


def test_stratified_split_is_disjoint_complete_and_proportional(classes, way):
    known = classes.where(F.col("urgency_level").isNotNull())
    ranked = by_class(known)
    shares = three_way({level: len(ids) for level, ids in ranked.items()})
    want = {}
    for level, ids in ranked.items():
        train, val = shares[level]
        want.update({i: "train" if n < train else "val" if n < train + val else "test" for n, i in enumerate(ids)})
    assert {r.id: r.split for r in sampling.stratified_split(known).collect()} == want


def test_many_strata(spark):
    table = spark.range(3000).withColumn("urgency_level", F.col("id") % 1500)
    assert sampling.sample_per_group(table, F.col("urgency_level"), 1).count() == 1500
    assert sampling.stratified_split(table).count() == 3000


def test_random_split(spark):
    got = Counter(r.split for r in sampling.random_split(spark.range(957)).collect())
    assert got == {"train": 861, "val": 96}
    assert sampling.random_split(spark.range(0)).collect() == []
    assert [r.split for r in sampling.random_split(spark.range(1)).collect()] == ["val"]


def test_shuffle_is_ordered_and_whole(spark):
    ids = [r.id for r in sampling.shuffled(spark.range(500)).collect()]
    assert ids == sorted(range(500), key=key)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_plan_for_every_size_and_no_job_to_build_it(spark, tmp_path):
    label = F.when(F.col("id") % 2 == 0, "max").otherwise("moderate")
    shapes = set()
    for rows in (100, 20000):
        path = str(tmp_path / str(rows))
        spark.range(rows).withColumn("urgency_level", label).write.parquet(path)
        table = spark.read.parquet(path)
        spark.sparkContext.setJobGroup(path, path)
        made = [sampling.balance_classes(table, target=30), sampling.cap_sample(table, 10), sampling.random_split(table)]
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(path)) == 0
        shapes.add(tuple(re.findall(r"(\w+Join|Window|Exchange \w+)", plan_of(m)).__repr__() for m in made))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(shapes) == 1


def test_rows_meet_their_limits_by_broadcast(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    joins = re.findall(r"\w+Join", plan_of(sampling.random_split(table)))
    assert joins[0].startswith("Broadcast")


def test_value_cuts_under_skew(spark):
    values = [5.0] * 700 + [float(i) / 7 for i in range(1301)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.5)] + [("b", None)], "g string, v double")
    cuts = [ranking.ValueCut(f"p{p}", p / 100, lambda n, p=p: F.least(F.floor(F.lit(p / 100) * n), n - 1)) for p in (0, 5, 35, 50, 95, 99, 100)]
    for accuracy in (20, 100, 10_000):
        got = {(r.stratum, r.cut): r.value for r in ranking.value_cuts(df.repartition(5), F.col("g"), F.col("v"), cuts, accuracy).collect()}
        ordered = sorted(values)
        for p in (0, 5, 35, 50, 95, 99, 100):
            assert got["a", f"p{p}"] == ordered[min(int(p / 100 * len(ordered)), len(ordered) - 1)]
            assert got["b", f"p{p}"] == 1.5


# --- pairs ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    level = F.when(F.col("id") % 3 == 0, "max").when(F.col("id") % 3 == 1, "moderate").otherwise("deferred")
    df = spark.range(60).select(
        "id", F.concat(F.lit("prompt "), F.floor(F.col("id") / 2)).alias("instruction"), level.alias("urgency_level"),
        F.lit("s").alias("source"), F.lit("fr").alias("language"),
    )
    body = F.concat(F.lit("body "), F.col("id"))
    return df.withColumn("response", render_answer(F.col("urgency_level"), body)).cache()


def test_synthetic_pairs(labelled):
    for r in pairs.synthetic_pairs(labelled).collect():
        level = K.LEVELS[[0, 1, 2][r.id % 3]]
        assert r.rejected.startswith(K.LEVEL_LABELS[K.WRONG_LEVEL[level]])
        assert f"body {r.id}\n" in r.rejected and r.chosen != r.rejected
        assert r.source == K.SOURCE_SYNTHETIC


def test_hard_negatives(labelled, rows, values):
    made = rows(
        [(0, "URGENCE DIFFÉRÉE x"), (1, "URGENCE MODÉRÉE x"), (2, "nothing"), (3, ""), (4, None), (99, "URGENCE MAXIMALE")],
        "id bigint, generated_response string",
    )
    got = pairs.hard_negatives(labelled, made)
    assert values(got, "id", "rejected", "source", "language") == [(0, "URGENCE DIFFÉRÉE x", K.SOURCE_HARD_NEGATIVE, "fr")]
    assert values(pairs.hard_negatives(labelled.drop("language"), made), "language") == [("en",)]


def test_preference_dataset_has_one_pair_per_prompt(labelled, values):
    made = labelled.select("id", F.lit("URGENCE MODÉRÉE x").alias("generated_response"))
    hard = pairs.hard_negatives(labelled, made)
    got = pairs.preference_dataset(labelled, hard, target=30).collect()
    assert len({r.prompt for r in got}) == len(got) > 15
    assert {r.source for r in got} <= {K.SOURCE_SYNTHETIC, K.SOURCE_HARD_NEGATIVE}
    alone = pairs.preference_dataset(labelled, target=30).collect()
    assert {r.source for r in alone} == {K.SOURCE_SYNTHETIC}
    assert dict(values(pairs.pair_label_counts(hard).where("side = 'rejected'"), "level", "n")) == {"moderate": 40}


# --- gates ----------------------------------------------------------------------------------


def test_null_check_counts_falsy_values(rows, values):
    df = rows([("a", 0.0, 1, True), ("", 0.8, 0, False), (None, None, 2, None)], "s string, f double, n int, b boolean")
    assert values(gates.null_check(df, ["s", "f", "n", "b"])) == [("b", 2), ("f", 2), ("n", 1), ("s", 2)]
    assert gates.missing_columns(df, ["s", "zz"]) == ["zz"]


def test_leakage_of_all_split_pairs(rows, values):
    df = rows([("train", "a"), ("test", "a"), ("test", "a"), ("val", "b"), ("test", "b"), ("train", "c")], "split string, k string")
    assert values(gates.leakage_check(df, "k")) == [("train", "test", 1), ("train", "val", 0), ("val", "test", 1)]
    assert values(gates.leaking_rows(df, "k"), "k") == [("a",)]


def test_class_gap(rows, values):
    df = rows([("a",)] * 60 + [("b",)] * 40, "l string")
    (gap, passed), = values(gates.class_gap(df, "l"))
    assert gap == pytest.approx(20) and not passed


def test_split_sizes_with_an_absent_split(spark, values):
    df = spark.range(4000).withColumn("split", F.lit("train"))
    assert values(gates.split_size_gate(df)) == [("test", 0, 500, False), ("train", 4000, 4000, True), ("val", 0, 500, False)]


def test_identical_pairs(rows, values):
    df = rows([("a", "a"), ("a", "b"), (None, None)], "chosen string, rejected string")
    assert values(gates.identical_pairs(df)) == [(3, 2)]


def test_rollup_ignores_warnings(rows, values):
    data = rows([(True,), (False,)], "ok boolean")
    warn = gates.gate_row(data, "gap", gates.WARN, F.col("ok"), F.lit("d"))
    block = gates.gate_row(data.where("ok"), "size", gates.BLOCK, F.col("ok"), F.lit("d"))
    assert ("overall", "block", True, "0") in values(gates.gate_rollup([warn, block]))
    failing = gates.gate_row(data, "size", gates.BLOCK, F.col("ok"), F.lit("d"))
    assert ("overall", "block", False, "1") in values(gates.gate_rollup([warn, failing]))


def test_export_check(rows, values):
    df = rows([("urgence",), ("x",)], "t string")
    assert values(gates.export_check(df, "t")) == [(2, 1)]


def test_only_large_strata_are_spread(spark, rows, values, monkeypatch):
    """Limits are multiplied for large strata alone; the joins give what a plain one gives, null keys too."""
    monkeypatch.setattr(ranking, "LARGE", 100)
    label = F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 50 != 1, F.concat(F.lit("s"), F.col("id") % 400))
    data = spark.range(4000).select("id", label.alias("k"))
    table = data.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    large = ranking.large_keys(data, "k")
    assert [r.k for r in large.where("k IS NOT NULL").collect()] == ["big"]
    wide = ranking.spread(table, large.where("k IS NOT NULL"), "k")
    assert wide.count() == table.count() + ranking.SALTS - 1
    joined = ranking.salted_join(data, table, "k", few=False)
    assert values(joined) == values(ranking.salted_join(data, table, "k", few=True))
    split = [sampling.stratified_split(data, "k", few=few) for few in (True, False)]
    assert values(split[0]) == values(split[1])


def test_few_rows_of_many_strata_are_taken_by_rank(spark, values, monkeypatch):
    """No table of limits, no salt: each task limits its groups first; rows that share an id stay together."""
    data = spark.range(3000).select((F.col("id") % 2900).alias("id"), (F.col("id") % 100 % 7).cast("string").alias("k"))
    want = {size: values(sampling.sample_per_group(data, F.col("k"), size)) for size in (1, 20)}
    monkeypatch.setattr(ranking, "BROADCAST_STRATA", 0)
    for size, kept in want.items():
        got = sampling.sample_per_group(data, F.col("k"), size)
        assert got.columns == ["id", "k"] and values(got) == kept
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Generate" not in plan and "Join" not in plan
