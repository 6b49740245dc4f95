"""Model mistakes fed back into the data, and models scored against a held-out split."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.chat import inference_text
from corpusloom.functions.labels import strip_artifacts
from corpusloom.operators.evaluation import prediction_table
from corpusloom.operators.pairs import hard_negatives
from corpusloom.operators.sampling import cap_sample
from corpusloom.operators.scoring import Scorer, score_table
from corpusloom.sources.stages import run_stage


def generate(
    rows: DataFrame,
    scorer_factory: Callable[[], Scorer],
    row_id: str = "id",
    text: str = "instruction",
    system: str | None = None,
    batch_size: int = 32,
    clean: bool = False,
) -> DataFrame:
    """``(id, generated_response, score_error, latency_ms)`` for every row.

    Only id and prompt travel to the model.  ``clean`` removes generation artefacts.
    """
    prompts = rows.select(
        row_id, inference_text(F.col(text), system or K.system_prompt()).alias("_prompt")
    )
    made = score_table(prompts, "_prompt", scorer_factory, batch_size).drop("_prompt")
    if clean:
        made = made.withColumn("generated_response", strip_artifacts(F.col("generated_response")))
    return made


def mine_hard_negatives(
    spark: SparkSession,
    train: DataFrame,
    scorer_factory: Callable[[], Scorer],
    root: str,
    overwrite: bool = False,
    **options,
) -> DataFrame:
    """Generate on the training split and keep the answers that name a wrong level.

    Generations are stored first: they are the costly part, and a failure after them must
    not repeat them.
    """
    at = root.rstrip("/")
    made = run_stage(
        spark, f"{at}/generations", lambda: generate(train, scorer_factory, **options), overwrite
    )
    return run_stage(
        spark, f"{at}/hard_negatives", lambda: hard_negatives(train, made), overwrite
    )


def predict(
    spark: SparkSession,
    held_out: DataFrame,
    models: dict[str, Callable[[], Scorer]],
    root: str,
    rows: int | None = None,
    overwrite: bool = False,
    **options,
) -> DataFrame:
    """Predictions of one or more models on the same rows, with a ``model`` column.

    ``rows`` evaluates a seeded sample of at most that many.
    """
    chosen = held_out if rows is None else cap_sample(held_out, rows)
    parts = []
    for name, factory in models.items():
        def made(factory=factory):
            return generate(chosen, factory, **options)

        stored = run_stage(spark, f"{root.rstrip('/')}/generations_{name}", made, overwrite)
        parts.append(prediction_table(chosen, stored).withColumn("model", F.lit(name)))
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    return predictions
