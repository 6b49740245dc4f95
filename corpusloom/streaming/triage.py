"""Request post-processing, the same for stored tables and for streams."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from corpusloom import constants as K
from corpusloom.functions.chat import inference_text
from corpusloom.functions.labels import level_label, parse_level, strip_placeholders
from corpusloom.operators.quality import request_gate
from corpusloom.operators.scoring import Scorer, score_table


def finish_responses(df: DataFrame, model: str, generated: str = "generated_response") -> DataFrame:
    """Clean a generated text, read its level, and attach label, disclaimer and model."""
    clean = strip_placeholders(F.coalesce(F.col(generated), F.lit("")))
    return (
        df.withColumn("raw_response", clean)
        .drop(generated)
        .withColumn("urgency_level", parse_level(F.col("raw_response")))
        .withColumn("urgency_label", level_label(F.col("urgency_level")))
        .withColumn("disclaimer", F.lit(K.DISCLAIMER))
        .withColumn("model", F.lit(model))
    )


def accepted(requests: DataFrame, text: str = "symptoms") -> DataFrame:
    """Requests with an allowed length."""
    return request_gate(requests, text).where("accepted").drop("accepted")


def rejected(requests: DataFrame, text: str = "symptoms") -> DataFrame:
    """The other requests."""
    return request_gate(requests, text).where(~F.col("accepted")).drop("accepted")


def triage(
    requests: DataFrame,
    scorer_factory: Callable[[], Scorer],
    model: str,
    text: str = "symptoms",
    system: str | None = None,
    batch_size: int = 32,
) -> DataFrame:
    """Gate, prompt, score and post-process; stateless, so batch and streaming agree."""
    prompted = accepted(requests, text).withColumn(
        "_prompt", inference_text(F.col(text), system or K.system_prompt())
    )
    scored = score_table(prompted, "_prompt", scorer_factory, batch_size).drop("_prompt")
    return finish_responses(scored, model)


def start_triage_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    answers: str,
    rejects: str,
    checkpoints: str,
    scorer_factory: Callable[[], Scorer],
    model: str,
    text: str = "symptoms",
    files_per_trigger: int | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Answer JSON requests as files arrive; rejected requests go to a sink of their own.

    One query: a batch is read once and both sinks are written from it, each into the folder
    ``batch_id=<id>``.  A batch repeated after a failure replaces what it wrote before, so the
    sinks agree on every batch and no request is answered twice.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, answers, rejects, scorer_factory, model, text)

    writer = (
        reader.json(source)
        .writeStream.queryName("triage")
        .foreachBatch(write)
        .option("checkpointLocation", os.path.join(checkpoints, "triage"))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return [writer.start()]


def write_batch(
    batch: DataFrame,
    batch_id: int,
    answers: str,
    rejects: str,
    scorer_factory: Callable[[], Scorer],
    model: str,
    text: str = "symptoms",
) -> None:
    """Write the answers and the rejected requests of one batch under its id, replacing those of an earlier try."""
    requests = batch.persist()
    try:
        for table, path in (
            (triage(requests, scorer_factory, model, text), answers),
            (rejected(requests, text), rejects),
        ):
            table.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
    finally:
        requests.unpersist()
