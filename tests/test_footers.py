"""Statistics from footers against the rows."""

import datetime

from corpusloom.sources.footers import footer_profile, footer_row, footer_session


def test_footers_against_the_rows(spark, rows, tmp_path, values):
    schema = "id long, `odd name` int, day date, x double, text string, parts array<int>"
    data = [(i, None if i % 3 else i, datetime.date(2024, 1, 1 + i), i / 4, None if i == 2 else f"t{i}", [i]) for i in range(20)]
    path, none = str(tmp_path / "t"), str(tmp_path / "none")
    rows(data, schema).repartition(4).write.parquet(path)
    rows([], schema).write.parquet(none)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    session = footer_session(spark)
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    row, flat = footer_row(session, path)
    plan = row._jdf.queryExecution().toString()  # noqa: SLF001
    # What is read are the counts, not the columns.
    assert "count(*):bigint" in plan and "count(text):bigint" in plan and len(flat) == 5
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert values(footer_profile(spark, {"t": path})) == sorted([
        ("t", "id", "bigint", 20, 0), ("t", "odd name", "int", 20, 13), ("t", "day", "date", 20, 0),
        ("t", "x", "double", 20, 0), ("t", "text", "string", 20, 1)], key=repr)
    both = footer_profile(spark, {"a": none, "b": [path, none]})
    assert {(r.table_name, r.n_rows, r.n_null) for r in both.where("column_name = 'id'").collect()} == {("a", 0, 0), ("b", 20, 0)}
