"""Sources, stages, the end-to-end jobs, and the streaming job."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.plans import build
from corpusloom import session
from corpusloom.session import materialize, release_tables, shared_folder
from corpusloom.sources import catalog as C
from corpusloom.sources import report, stages
from corpusloom.streaming import triage as T


class FakeSession:
    """A session that names a shared folder, or none, on a cluster."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert shared_folder(FakeSession("hdfs://shared/x")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession(None))


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(5).withColumn("x", F.lit("a"))
    stored = materialize(df)
    assert stored.dtypes == df.dtypes and stored.count() == 5


def test_release_deletes_the_tables_of_the_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    materialize(spark.range(5))
    folder = tmp_path / "tables" / spark.sparkContext.applicationId
    assert len(os.listdir(folder)) == 1
    release_tables(spark)
    assert not folder.exists()


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(3).withColumn("source", F.lit("s")).write.parquet(str(tmp_path / "train"))
    spark.range(2).withColumn("source", F.lit("t")).write.parquet(str(tmp_path / "test"))
    spark.range(4).write.json(str(tmp_path / "rows"))
    config = {"tables": {
        "both": {"paths": {"train": str(tmp_path / "train"), "test": [str(tmp_path / "test"), str(tmp_path / "gone")]}},
        "rows": {"path": str(tmp_path / "rows"), "format": "json", "usage": "dpo", "schema": "id bigint"},
        "lost": {"path": str(tmp_path / "lost")},
    }}
    return C.catalog_from_config(config)


def test_catalog(spark, tables, values):
    assert values(C.load_table(spark, tables, "both").groupBy("split").count()) == [("test", 2), ("train", 3)]
    assert list(C.by_usage(tables, "dpo")) == ["rows"]
    with pytest.raises(FileNotFoundError):
        C.load_table(spark, C.catalog_from_config({"tables": {"t": {"paths": {"train": tables["both"].paths["train"], "val": "gone"}}}}), "t")
    loaded, outcome = C.load_all(spark, tables)
    assert sorted(loaded) == ["both", "rows"]
    assert values(outcome, "name", "ok") == [("both", True), ("lost", False), ("rows", True)]


def test_views_and_overview(spark, tables, values):
    registered, skipped = C.register_views(spark, tables)
    assert (registered, skipped) == (["both_train", "both_test", "rows"], ["lost"])
    assert C.run_query(spark, "SELECT COUNT(*) AS n FROM both_train").first().n == 3
    got = values(C.catalog_overview(spark, ["both_test", "rows", "absent_view"]))
    assert ("both_test", "rows", "*", 2) in got and ("both_test", "source", "t", 2) in got
    assert ("rows", "column", "id:bigint", 1) in got
    assert [r[0] for r in got if r[1] == "error"] == ["absent_view"]


def test_stage_is_built_once(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(len(calls))

    path = str(tmp_path / "stage")
    assert stages.run_stage(spark, path, make).count() == 1
    assert stages.run_stage(spark, path, make).count() == 1 and len(calls) == 1
    os.remove(tmp_path / "stage" / "_SUCCESS")
    assert stages.run_stage(spark, path, make).count() == 2
    assert stages.run_stage(spark, path, make, overwrite=True).count() == 3


def test_splits_and_export(spark, tmp_path, values):
    df = spark.range(4).select(
        "id", F.when(F.col("id") < 3, "train").otherwise("val").alias("split"),
        F.lit("fr").alias("language"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"),
    )
    stages.write_splits(df, str(tmp_path / "s"))
    with pytest.raises(Exception):
        stages.write_splits(df, str(tmp_path / "s"))
    assert {n: t.count() for n, t in stages.read_splits(spark, str(tmp_path / "s")).items()} == {"train": 3, "val": 1}
    assert values(stages.dataset_card(df, extra={"licence": "mit"})) == [
        ("train", 3, "fr", "s0,s1", "mit"), ("val", 1, "fr", "s1", "mit"),
    ]
    assert stages.export_dataset(df, str(tmp_path / "out"), "json") is None
    assert spark.read.json(str(tmp_path / "out" / "card")).count() == 2
    assert "nosuchfs" in stages.export_dataset(df, "nosuchfs://x/y")


def test_markdown(spark):
    df = spark.createDataFrame([("a|b", 0.5, None)], "x string, y double, z string")
    assert report.to_markdown(df) == "| x | y | z |\n|---|---|---|\n| a\\|b | 0.5 |  |"
    assert len(report.to_markdown(spark.range(500)).split("\n")) == 502
    assert report.report("T", {"S": df}).startswith("# T\n\n## S\n\n| x |")


def test_end_to_end(spark, tmp_path, values):
    words = " ".join(["word"] * 25)
    topics = ["stroke", "vaccine", "nothing"]
    qa = [(i, f"question {i} {topics[i % 3]} a{i % 7}@mail.example.com", f"{words} {i}") for i in range(90)]
    qa += [(100, qa[0][1], qa[0][2]), (101, "short", "too short"), (102, "markup", words + " <b>x</b>")]
    folder = str(tmp_path / "qa")
    spark.createDataFrame(qa, "id bigint, Question string, Answer string").write.parquet(folder)
    catalog = {K.SOURCE_QA: C.TableEntry({"train": folder}), "unused": C.TableEntry({"train": "gone"})}
    out = build.prepare_sft(spark, catalog, str(tmp_path / "work"), target=60)
    assert values(out["outcomes"], "name", "ok") == [(K.SOURCE_QA, True)]
    final = out["sft"]
    assert values(out["sft_raw"].groupBy("urgency_level").count()) == [("deferred", 20), ("max", 20), ("moderate", 20)]
    assert final.where(F.contains("instruction", F.lit("@"))).count() == 0
    assert final.where(F.contains("instruction", F.lit("<EMAIL_ADDRESS>"))).count() == final.count() == 60
    assert dict(values(final.groupBy("split").count())) == {"train": 48, "val": 6, "test": 6}
    checks = {(r.gate, r.detail): r.passed for r in build.check_sft(final, {"train": 40, "val": 5, "test": 5}).collect()}
    assert checks["overall", "0"] and checks["leakage", "train|test"]
    assert not [r for r in build.check_sft(final).where("gate = 'overall'").collect() if r.passed]

    pair = build.prepare_pairs(spark, out["sft_raw"], str(tmp_path / "work"), target=30)
    assert sum(r["count"] for r in pair["dpo"].groupBy("split").count().collect()) == 30
    assert [r.passed for r in build.check_pairs(pair["dpo"]).where("gate = 'overall'").collect()] == [True]
    text = report.report("Statistics", build.statistics_tables(final, pair["dpo"]))
    assert "## SFT splits" in text and "| train | 48 |" in text
    # A second run reads the stored stages.
    again = build.prepare_sft(spark, {}, str(tmp_path / "work"), target=60)
    assert values(again["sft"].groupBy("split").count()) == values(final.groupBy("split").count())


ANSWERS = {"max": "URGENCE MAXIMALE\n\n<PERSON> appelez", "none": "I cannot tell."}


@pytest.fixture
def scorer_factory():
    def factory():
        def score(prompts):
            return [ANSWERS["max"] if "thoracique" in p else ANSWERS["none"] for p in prompts]

        return score

    return factory


REQUESTS = [
    ("r1", "Douleur thoracique intense"), ("r2", "court"), ("r3", "x" * 2000), ("r4", "x" * 2001), ("r5", "x" * 10), ("r6", None),
]


def test_triage_of_a_table(rows, values, scorer_factory):
    got = T.triage(rows(REQUESTS, "id string, symptoms string"), scorer_factory, "m1", system="s")
    assert values(got, "id", "urgency_level", "urgency_label", "raw_response") == [
        ("r1", "max", "URGENCE MAXIMALE", "URGENCE MAXIMALE\n\n appelez"),
        ("r3", None, K.UNKNOWN_LEVEL_LABEL, "I cannot tell."),
        ("r5", None, K.UNKNOWN_LEVEL_LABEL, "I cannot tell."),
    ]
    assert {(r.disclaimer, r.model) for r in got.collect()} == {(K.DISCLAIMER, "m1")}


def test_stream_agrees_with_the_table_and_survives_a_restart(
    spark, rows, tmp_path, values, scorer_factory
):
    source = tmp_path / "in"
    source.mkdir()

    def arrive(name, data):
        lines = [json.dumps({"id": i, "symptoms": s}) for i, s in data]
        (source / f"{name}.json").write_text("\n".join(lines))

    def run():
        for query in T.start_triage_stream(
            spark, str(source), "id string, symptoms string", str(tmp_path / "answers"), str(tmp_path / "rejects"),
            str(tmp_path / "checkpoints"), scorer_factory, "m1", available_now=True,
        ):
            assert query.awaitTermination(120)

    arrive("a", REQUESTS[:3])
    run()
    arrive("b", REQUESTS[3:])
    run()
    static = T.triage(rows(REQUESTS, "id string, symptoms string"), scorer_factory, "m1")
    columns = [c for c in static.columns if c != "latency_ms"]
    assert values(spark.read.parquet(str(tmp_path / "answers")), *columns) == values(static, *columns)
    assert values(spark.read.parquet(str(tmp_path / "rejects")), "id") == [("r2",), ("r4",), ("r6",)]


def test_a_repeated_batch_replaces_itself(spark, rows, tmp_path, values, scorer_factory):
    schema = "id string, symptoms string"
    answers, rejects = str(tmp_path / "answers"), str(tmp_path / "rejects")

    def written():
        return values(spark.read.parquet(answers), "id", "batch_id"), values(spark.read.parquet(rejects), "id", "batch_id")

    T.write_batch(rows(REQUESTS[:3], schema), 0, answers, rejects, scorer_factory, "m1")
    T.write_batch(rows(REQUESTS[3:], schema), 1, answers, rejects, scorer_factory, "m1")
    first = written()
    assert first[0] == [("r1", 0), ("r3", 0), ("r5", 1)] and first[1] == [("r2", 0), ("r4", 1), ("r6", 1)]
    # The second sink of batch 1 fails after the first was written; the batch comes again.
    with pytest.raises(Exception):
        T.write_batch(rows(REQUESTS[3:], schema), 1, answers, "nosuchfs://x", scorer_factory, "m1")
    T.write_batch(rows(REQUESTS[3:], schema), 1, answers, rejects, scorer_factory, "m1")
    assert written() == first


def test_sources_without_ids_and_failed_sources(spark, tmp_path, values):
    words = " ".join(["word"] * 25)
    rows = [("t", f"question {i} {['stroke', 'vaccine', 'nothing'][i % 3]}", f"{words} {i}") for i in range(30)]
    folder = str(tmp_path / "qa")
    spark.createDataFrame(rows + rows[:3], "qtype string, Question string, Answer string").write.parquet(folder)
    catalog = {K.SOURCE_QA: C.TableEntry({"train": folder, "val": str(tmp_path / "gone")})}
    with pytest.raises(RuntimeError, match="gone|val"):
        build.prepare_sft(spark, catalog, str(tmp_path / "strict"), target=30)
    out = build.prepare_sft(spark, catalog, str(tmp_path / "lenient"), target=30, skip_failed=True)
    assert out["sft"].count() == 30 and out["sft"].select("id").distinct().count() == 30
    assert values(out["outcomes"], "name", "ok") == [(K.SOURCE_QA, True)]


def test_every_request_waits_for_its_batch(spark):
    import time

    from corpusloom.operators.scoring import score_table

    def factory():
        def scorer(texts):
            time.sleep(0.2)
            return list(texts)

        return scorer

    rows = spark.range(64).selectExpr("id", "'x' AS text").coalesce(1)
    assert min(r.latency_ms for r in score_table(rows, "text", factory).collect()) >= 200
