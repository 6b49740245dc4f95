"""Session construction and the two ways a job may cut its lineage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for this workload on any cluster.  Shuffle parallelism is left to
# AQE: start high, let it coalesce.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "corpusloom", cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    local = {
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in {**DEFAULT_CONF, **local, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session.  Only a session in local mode, where
    one machine is the whole cluster, may fall back to its warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_shared")


def _tables_of(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    return os.path.join(shared_folder(spark), "tables", app)


def new_folder(spark: SparkSession) -> str:
    """A path of its own for a stored table of this application; nothing is created yet."""
    return os.path.join(_tables_of(spark), uuid.uuid4().hex)


def release_tables(spark: SparkSession) -> None:
    """Delete what lies in folders of ``new_folder`` for this application; call when its results are stored."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs  # noqa: SLF001
    folder = hadoop.Path(_tables_of(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    system.delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` now to the shared folder and continue from the stored table.

    For a table that several passes read and that is costly to recompute.  Unlike
    ``checkpoint()`` the stored form is columnar, so each later pass reads only the columns
    it needs; like it, it survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
