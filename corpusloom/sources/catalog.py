"""Named tables: a small catalog of paths, loading, views and overviews."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import arrow_shards


@dataclass(frozen=True)
class TableEntry:
    """Where a table lies.  ``paths`` maps a split name to one path or several."""

    paths: Mapping[str, str | list[str]]
    format: str = "parquet"
    usage: str = "sft"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None


Catalog = Mapping[str, TableEntry]


def catalog_from_config(config: Mapping) -> dict[str, TableEntry]:
    """A catalog from a plain mapping, such as a parsed YAML or JSON file.

    ``{"tables": {name: {"path": p | "paths": {split: p}, "format": f, "usage": u}}}``
    """
    entries = {}
    for name, entry in config["tables"].items():
        paths = entry.get("paths") or {"train": entry["path"]}
        entries[name] = TableEntry(
            paths, entry.get("format", "parquet"), entry.get("usage", "sft"),
            entry.get("options", {}), entry.get("schema"),
        )
    return entries


def by_usage(catalog: Catalog, usage: str) -> dict[str, TableEntry]:
    """The entries of one usage."""
    return {name: entry for name, entry in catalog.items() if entry.usage == usage}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names; globs allowed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs  # noqa: SLF001
    location = hadoop.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    found = system.globStatus(location)
    return found is not None and len(found) > 0


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of ``paths`` that exist, in order; each folder is listed once, whatever it should hold."""
    wanted = list(paths)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    held: dict[str, set[str]] = {}
    found = []
    for path in wanted:
        location = hadoop.Path(path)
        parent = location.getParent()
        if len(wanted) == 1 or parent is None or any(sign in path for sign in "*?[{"):
            if path_exists(spark, path):
                found.append(path)
            continue
        folder = parent.toString()
        if folder not in held:
            system = parent.getFileSystem(conf)
            listed = system.listStatus(parent) if system.exists(parent) else []
            held[folder] = {status.getPath().getName() for status in listed}
        if location.getName() in held[folder]:
            found.append(path)
    return found


def read_existing(
    spark: SparkSession,
    paths: str | Iterable[str],
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: str | None = None,
) -> DataFrame | None:
    """Read the paths that exist as one table; null when none does."""
    existing = existing_paths(spark, [paths] if isinstance(paths, str) else paths)
    if not existing:
        return None
    if format == arrow_shards.FORMAT:
        arrow_shards.register(spark)
    reader = spark.read.format(format).options(**dict(options or {}))
    if schema:
        reader = reader.schema(schema)
    return reader.load(existing[0] if len(existing) == 1 else existing)


def load_table(
    spark: SparkSession, catalog: Catalog, name: str, skip_missing: bool = False
) -> DataFrame:
    """All splits of a table, concatenated, with their name in ``split``.

    Of several shards of a split those that exist are read; a split without any is an error
    unless ``skip_missing``.
    """
    entry = catalog[name]
    parts, lost = [], []
    for split, paths in entry.paths.items():
        part = read_existing(spark, paths, entry.format, entry.options, entry.schema)
        if part is None:
            lost.append(split)
        else:
            parts.append(part.withColumn("split", F.lit(split)))
    if not parts:
        raise FileNotFoundError(f"no path of table {name!r} exists")
    if lost and not skip_missing:
        raise FileNotFoundError(f"no path of the splits {lost} of table {name!r} exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_all(
    spark: SparkSession,
    catalog: Catalog,
    names: Iterable[str] | None = None,
    skip_missing: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load many tables, going on after a failure; also returns ``(name, ok, error)``.

    With ``skip_missing`` a table counts as loaded if some of its splits are there.

    Only schemas are read here; rows are read when the tables are used.
    """
    tables, outcome = {}, []
    for name in names or catalog:
        try:
            tables[name] = load_table(spark, catalog, name, skip_missing)
            outcome.append((name, True, None))
        except (PySparkException, FileNotFoundError, KeyError) as failure:
            outcome.append((name, False, str(failure)))
    return tables, spark.createDataFrame(outcome, "name string, ok boolean, error string")


def register_views(
    spark: SparkSession, catalog: Catalog, per_split: bool = True
) -> tuple[list[str], list[str]]:
    """Register every table as a temporary view; returns the names registered and skipped.

    A table with several splits becomes one view per split, ``<name>_<split>``.
    """
    registered, skipped = [], []
    for name, entry in catalog.items():
        found = False
        for split, paths in entry.paths.items():
            part = read_existing(spark, paths, entry.format, entry.options, entry.schema)
            if part is None:
                continue
            view = f"{name}_{split}" if per_split and len(entry.paths) > 1 else name
            part.createOrReplaceTempView(view)
            registered.append(view)
            found = True
        if not found:
            skipped.append(name)
    return registered, skipped


def run_query(spark: SparkSession, query: str) -> DataFrame:
    """Ad-hoc SQL on the registered views."""
    return spark.sql(query)


def catalog_overview(spark: SparkSession, views: Iterable[str] | None = None) -> DataFrame:
    """``(table_name, kind, key, n)`` for every view: rows, columns, sources, languages.

    Kinds: ``rows`` (n = count), ``column`` (key = ``name:type``, n = position), ``source``
    and ``language`` (key = value, n = count), ``error`` for a view that cannot be analysed.
    """
    names = list(views) if views is not None else sorted(
        t.name for t in spark.catalog.listTables() if t.isTemporary
    )
    shape = "table_name string, kind string, key string, n bigint"
    fixed, parts = [], []

    def rows_of(table: DataFrame, name: str, kind: str, key) -> DataFrame:
        return table.select(
            F.lit(name).alias("table_name"), F.lit(kind).alias("kind"),
            key.cast("string").alias("key"), F.col("n").cast("bigint").alias("n"),
        )

    for name in names:
        try:
            view = spark.table(name)
            columns = view.dtypes
        except PySparkException as failure:
            fixed.append((name, "error", str(failure).splitlines()[0], None))
            continue
        fixed += [(name, "column", f"{c}:{t}", i) for i, (c, t) in enumerate(columns, 1)]
        parts.append(
            rows_of(view.agg(F.count(F.lit(1)).alias("n")), name, "rows", F.lit("*"))
        )
        for kind in ("source", "language"):
            if kind in view.columns:
                counts = view.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
                parts.append(rows_of(counts, name, kind, F.col(kind)))
    described = spark.createDataFrame(fixed, shape)
    return reduce(DataFrame.unionByName, parts, described)
