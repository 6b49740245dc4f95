"""Rows and nulls per column of Parquet tables from their footers, without reading a row.

Spark answers counts from the statistics of the files if its newer Parquet reader is in use and
aggregates are pushed to it; both are settings of a session, so the tables are read in a session of
their own that shares the application.  Minima and maxima are not taken from footers: a block of
nulls has none, at which Spark's reader stops.  A file written without statistics stops the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans take aggregates."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_row(session: SparkSession, path: str | list[str]) -> tuple[DataFrame, list[StructField]]:
    """One row of counts over a table, and its fields that are not nested."""
    table = session.read.parquet(*([path] if isinstance(path, str) else path))
    flat = [f for f in table.schema.fields if f.dataType.typeName() not in ("array", "map", "struct", "variant")]
    known = [F.count(F.col("`" + f.name.replace("`", "``") + "`")).alias(f"known_{at}") for at, f in enumerate(flat)]
    return table.agg(F.count(F.lit(1)).alias("n"), *known), flat


def footer_profile(spark: SparkSession, tables: Mapping[str, str | list[str]]) -> DataFrame:
    """``(table_name, column_name, type, n_rows, n_null)``, a row per table and column that is not nested.

    The counts of a table, one row, come to the driver as the frame is built: over files without any
    row Spark's pushed counts are null, in columns it plans as never null, so no expression can mend them.
    """
    session, found = footer_session(spark), []
    for name, path in tables.items():
        row, flat = footer_row(session, path)
        counts = row.first()
        n_rows = counts["n"] or 0
        for at, one in enumerate(flat):
            found.append((name, one.name, one.dataType.simpleString(), n_rows, n_rows - (counts[f"known_{at}"] or 0)))
    return spark.createDataFrame(
        found, "table_name string, column_name string, type string, n_rows bigint, n_null bigint")
