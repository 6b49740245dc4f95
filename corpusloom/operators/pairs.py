"""Preference pairs: a right answer and a wrong one for the same prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import answer_body, parse_level, render_answer
from corpusloom.functions.text import is_empty, literal_map
from corpusloom.operators.dedup import dedup_by_priority
from corpusloom.operators.sampling import cap_sample, stratified_sample


def synthetic_pairs(df: DataFrame, row_id: str = "id") -> DataFrame:
    """Pair each answer with the same body presented at a wrong level."""
    wrong = literal_map(K.WRONG_LEVEL, F.col("urgency_level"))
    return df.select(
        F.col(row_id).alias("id"),
        F.col("instruction").alias("prompt"),
        F.col("response").alias("chosen"),
        render_answer(wrong, answer_body(F.col("response"))).alias("rejected"),
        F.lit(K.SOURCE_SYNTHETIC).alias("source"),
        F.col("language"),
    )


def hard_negatives(
    truth: DataFrame,
    generations: DataFrame,
    row_id: str = "id",
    generated: str = "generated_response",
) -> DataFrame:
    """Pair each answer with a generated one that names another level.

    Generations are matched by id.  Empty ones and those without a readable level are
    dropped before the join, so only usable text is shuffled.
    """
    usable = (
        generations.select(row_id, generated)
        .where(~is_empty(F.col(generated)))
        .withColumn("_named", parse_level(F.col(generated)))
        .where(F.col("_named").isNotNull())
    )
    language = F.col("language") if "language" in truth.columns else F.lit("en")
    return (
        truth.join(usable, row_id)
        .where(F.col("_named") != F.col("urgency_level"))
        .select(
            F.col(row_id).alias("id"),
            F.col("instruction").alias("prompt"),
            F.col("response").alias("chosen"),
            F.col(generated).alias("rejected"),
            F.lit(K.SOURCE_HARD_NEGATIVE).alias("source"),
            language.alias("language"),
        )
    )


def preference_dataset(
    labelled: DataFrame,
    hard: DataFrame | None = None,
    target: int = K.PAIR_TARGET_ROWS,
    seed: int = K.SEED,
) -> DataFrame:
    """Synthetic pairs of a class-balanced sample, plus capped hard negatives, one per prompt.

    Ids are unique within each source only, so the order among both uses ``source:id``.
    """
    sample = stratified_sample(labelled, target=target, seed=seed)
    pairs = dedup_by_priority(synthetic_pairs(sample), seed=seed)
    if hard is not None:
        pairs = pairs.unionByName(cap_sample(hard, target, seed=seed))
    keyed = pairs.withColumn("pair_id", F.concat_ws(":", "source", "id"))
    return dedup_by_priority(keyed, row_id="pair_id", seed=seed)


def pair_label_counts(df: DataFrame) -> DataFrame:
    """How often each level is named by ``chosen`` and by ``rejected``."""

    def named(column: str):
        level = F.coalesce(parse_level(F.col(column)), F.lit("unknown"))
        return F.struct(F.lit(column).alias("side"), level.alias("level"))

    return (
        df.select(F.inline(F.array(named("chosen"), named("rejected"))))
        .groupBy("side", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )
