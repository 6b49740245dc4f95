"""Versioned stages: what is rebuilt, what survives a rebuild that dies, what digests see."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.sources.versions import Stage, StageStore


@pytest.fixture
def store(spark, tmp_path):
    """Two inputs, two stages that read one each, and one that reads both."""
    for name in ("a", "b"):
        spark.range(20).withColumn("k", F.col("id") % 4).write.parquet(str(tmp_path / name))
    calls = []

    def stages(limit=10, broken=False):
        def first(rows):
            calls.append("first")
            kept = rows.where(F.col("id") < limit)
            return kept.withColumn("id", F.raise_error(F.lit("dies")).cast("long")) if broken else kept

        def second(rows):
            calls.append("second")
            return rows.groupBy("k").count()

        def both(left, right):
            calls.append("both")
            return left.join(right, "k")

        return StageStore(spark, str(tmp_path / "out"), {
            "both": Stage(both, ["first", "second"]),
            "first": Stage(first, [str(tmp_path / "a")], {"limit": limit}),
            "second": Stage(second, [str(tmp_path / "b")], partition_by=["k"]),
        })

    stages.calls, stages.folder = calls, tmp_path
    return stages


def rows_of(df):
    return sorted(map(tuple, df.select("id", "k", "count").collect()))


def test_built_once(store):
    want = rows_of(store().ensure("both"))
    assert want == [(k, k % 4, 5) for k in range(10)]
    again = store()
    assert rows_of(again.ensure("both")) == want and again.built == [] and again.stale() == []
    assert store.calls == ["first", "second", "both"]


def test_only_what_depends_on_a_change(spark, store):
    store().ensure("both")
    spark.range(20, 24).withColumn("k", F.col("id") % 4).write.mode("append").parquet(str(store.folder / "b"))
    after = store()
    assert after.stale() == ["second", "both"]
    assert rows_of(after.ensure("both"))[0] == (0, 0, 6) and after.built == ["second", "both"]
    other = store(limit=3)
    assert len(rows_of(other.ensure("both"))) == 3 and other.built == ["first", "both"]


def test_same_rows_stop_the_rebuild(spark, store):
    """Files of the input change, rows of the stage do not: what reads the stage stays."""
    store().ensure("both")
    spark.range(50, 60).withColumn("k", F.col("id") % 4).write.mode("append").parquet(str(store.folder / "a"))
    after = store()
    after.ensure("both")
    assert after.built == ["first"] and after.stale() == []
    forced = store()
    forced.ensure("second", force=True)
    forced.ensure("both")
    assert forced.built == ["second"]


def test_rebuild_that_dies_leaves_the_version_of_before(store):
    want = rows_of(store().ensure("both"))
    held = store().manifest("first")
    with pytest.raises(PySparkException):
        store(limit=5, broken=True).ensure("both")
    after = store()
    assert after.manifest("first") == held and rows_of(after.read("both")) == want
    assert len(os.listdir(store.folder / "out/first")) >= 3  # two versions and the pointer
    mended = store(limit=5)
    assert len(rows_of(mended.ensure("both"))) == 5 and mended.built == ["first", "both"]
    assert len(mended.clean()) == 3 and len(rows_of(mended.read("both"))) == 5 and mended.clean() == []


def test_killed_before_the_pointer(store, monkeypatch):
    """Data and manifest stand, the pointer does not: the stage is built again."""
    one = store()
    kept = one.files.replace
    monkeypatch.setattr(one.files, "replace", lambda name, text: kept(name, text) if "manifest" in name else exec("raise OSError"))
    with pytest.raises(OSError):
        one.ensure("second")
    after = store()
    assert after.manifest("second") is None
    with pytest.raises(FileNotFoundError):
        after.read("second")
    assert after.ensure("second").count() == 4 and after.built == ["second"]


def test_digests(spark, tmp_path):
    """Order and partitions do not count; values, repeats and column names do; maps are hashed too."""
    def digest(rows):
        held = StageStore(spark, str(tmp_path / os.urandom(4).hex()), {"x": Stage(lambda: rows)})
        held.ensure("x")
        return held.manifest("x")["digest"]

    base = spark.range(100).withColumn("m", F.create_map(F.lit("a"), "id", F.lit("b"), F.lit(None).cast("long")))
    assert digest(base) == digest(base.orderBy(F.desc("id"))) == digest(base.repartition(7))
    swapped = base.withColumn("m", F.create_map(F.lit("b"), F.lit(None).cast("long"), F.lit("a"), "id"))
    assert digest(base) == digest(swapped)
    others = [base.limit(99), base.union(base.limit(1)), base.withColumnRenamed("id", "i"), base.union(base),
              base.withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id")))]
    assert len({digest(rows) for rows in [base, *others]}) == 6
    assert digest(base.limit(0)) == digest(base.limit(0))


def test_stages_that_read_each_other(spark, tmp_path):
    loop = StageStore(spark, str(tmp_path), {"a": Stage(lambda x: x, ["b"]), "b": Stage(lambda x: x, ["a"])})
    with pytest.raises(ValueError):
        loop.ensure("a")
