"""Arrow stream shards as source and sink."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.sources import arrow_shards as A
from corpusloom.sources.catalog import TableEntry, existing_paths, load_table


@pytest.fixture(autouse=True)
def known(spark):
    A.register(spark)


def shard(path, table):
    with pa.OSFile(str(path), "wb") as sink, pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table, max_chunksize=2)


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.range(1000).select(
        "id", F.concat(F.lit("é"), "id").alias("t"), F.array("id").alias("l"), F.struct("id", F.lit(None).cast("double").alias("x")).alias("s"))
    rows.repartition(3).write.format(A.FORMAT).mode("append").save(path)
    assert sorted(os.listdir(path)) == [f"data-0000{k}-of-00003.arrow" for k in range(3)] + [A.STATE]
    back = spark.read.format(A.FORMAT).load(path)
    assert back.schema.simpleString() == rows.schema.simpleString() and back.rdd.getNumPartitions() == 3
    assert sorted(back.collect()) == sorted(rows.collect())
    assert sum(json.load(open(f"{path}/{A.STATE}"))["rows"]) == 1000


def test_overwrite_and_refusal(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(9).repartition(3).write.format(A.FORMAT).mode("append").save(path)
    with pytest.raises(PySparkException):
        spark.range(4).coalesce(1).write.format(A.FORMAT).mode("append").save(path)
    assert spark.read.format(A.FORMAT).load(path).count() == 9
    spark.range(4).coalesce(1).write.format(A.FORMAT).mode("overwrite").save(path)
    assert sorted(os.listdir(path)) == ["data-00000-of-00001.arrow", A.STATE]
    spark.range(0).write.format(A.FORMAT).mode("overwrite").save(path)
    assert spark.read.format(A.FORMAT).load(path).collect() == []


def test_failed_write_leaves_the_old_shards(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(9).repartition(3).write.format(A.FORMAT).mode("append").save(path)
    before = sorted(os.listdir(path))
    broken = spark.range(20).repartition(4).select(F.when(F.col("id") == 13, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        broken.write.format(A.FORMAT).mode("overwrite").save(path)
    # A task that was killed may leave its attempt, which no reader sees and the next write deletes.
    assert [name for name in sorted(os.listdir(path)) if name[0] != "_"] == before
    assert spark.read.format(A.FORMAT).load(path).count() == 9


def test_missing_shards(spark, tmp_path):
    path = tmp_path / "a"
    spark.range(0, 30, 1, 3).write.format(A.FORMAT).mode("append").save(str(path))
    os.remove(path / "data-00001-of-00003.arrow")
    assert A.missing_shards(str(path)) == ["data-00001-of-00003.arrow"]
    assert spark.read.format(A.FORMAT).load(str(path)).count() == 20
    with pytest.raises(PySparkException):
        spark.read.format(A.FORMAT).option("missing", "error").load(str(path)).count()
    with pytest.raises(PySparkException):
        spark.read.format(A.FORMAT).load(str(tmp_path / "nowhere")).count()


def test_shards_of_other_writers(spark, tmp_path):
    """Wide strings, dictionaries, an added column, a lost one, and the format with a footer."""
    first = pa.table({"id": pa.array([1, 2, 3], pa.int64()), "t": pa.array(["a", None, "c"], pa.large_string())})
    second = pa.table({"id": pa.array([4], pa.int32()), "more": pa.array([True])})
    third = pa.table({"t": pa.array(["x", "y"]).dictionary_encode(), "id": pa.array([5, None], pa.int64())})
    shard(tmp_path / "data-0.arrow", first)
    shard(tmp_path / "data-1.arrow", second)
    with pa.OSFile(str(tmp_path / "data-2.arrow"), "wb") as sink, pa.ipc.new_file(sink, third.schema) as file:
        file.write_table(third)
    back = spark.read.format(A.FORMAT).load(str(tmp_path))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [(1, "a"), (2, None), (3, "c"), (4, None), (5, "x"), (None, "y")], key=repr)


def test_catalog_lists_each_folder_once(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(0, 30, 1, 3).write.format(A.FORMAT).mode("append").save(path)
    shards = [f"{path}/data-{k:05d}-of-00003.arrow" for k in range(4)] + [f"{tmp_path}/gone/data.arrow", f"{path}/*00002-of*"]
    assert existing_paths(spark, shards) == [*shards[:3], shards[5]]
    entry = TableEntry({"train": shards[1:4], "test": [shards[0]]}, format=A.FORMAT)
    table = load_table(spark, {"x": entry}, "x")
    assert sorted(map(tuple, table.groupBy("split").count().collect())) == [("test", 10), ("train", 20)]
