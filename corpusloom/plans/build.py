"""End-to-end jobs: from normalised rows to final, checked splits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import CLINICAL_LEXICON, Lexicon
from corpusloom.functions.pii import DEFAULT_RECOGNIZERS, Recognizer, SpanModel
from corpusloom.operators import gates, pii, stats
from corpusloom.operators.dedup import dedup_key, dedup_pair
from corpusloom.operators.labeling import add_answer, label_by_lexicon, label_with
from corpusloom.operators.normalize import SOURCES, Normalizer, union_sources
from corpusloom.operators.pairs import preference_dataset
from corpusloom.operators.quality import quality_filter
from corpusloom.operators.sampling import balance_classes, random_split, stratified_split
from corpusloom.sources.catalog import Catalog, load_all
from corpusloom.sources.stages import run_stage

SFT_TEXT = ["instruction", "response"]
PAIR_TEXT = ["prompt", "chosen", "rejected"]


def label_rows(
    normalized: DataFrame,
    lexicon: Lexicon = CLINICAL_LEXICON,
    classify: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Filter, label and render: one map-only pass.

    The filter comes first, so rejected rows are neither labelled nor rendered.
    """
    good = quality_filter(normalized)
    if classify is None:
        labelled = label_by_lexicon(good, lexicon=lexicon)
    else:
        labelled = label_with(good, classify, F.concat_ws(" ", "instruction", "raw_response"))
    return add_answer(labelled).select("id", *K.SFT_COLUMNS)


def build_training_table(
    normalized: DataFrame,
    lexicon: Lexicon = CLINICAL_LEXICON,
    classify: Callable[[Column], Column] | None = None,
    target: int = K.SFT_TARGET_ROWS,
    recognizers: Sequence[Recognizer] = DEFAULT_RECOGNIZERS,
    allowlist: Sequence[str] = tuple(K.PERSON_ALLOWLIST),
    seed: int = K.SEED,
    root: str | None = None,
) -> DataFrame:
    """Normalised rows to the final split table, in one go.

    With ``root``, stored twice below it: after the first deduplication, whose shuffle is then
    not repeated by the passes of the balancing, and after masking, whose Python workers are not
    either.  Without, nothing is written and the passes repeat that work.
    """

    def step(name: str, made: DataFrame) -> DataFrame:
        if root is None:
            return made
        return run_stage(made.sparkSession, f"{root.rstrip('/')}/{name}", lambda: made, True)

    unique = step("unique", dedup_pair(label_rows(normalized, lexicon, classify)))
    balanced = balance_classes(unique, target=target, seed=seed)
    masked = pii.anonymize(
        balanced, SFT_TEXT, recognizers=recognizers, allowlist=allowlist
    ).drop("entities")
    final = step("masked", dedup_key(masked, "instruction"))
    return stratified_split(final, seed=seed)


def with_row_id(table: DataFrame, source: str) -> DataFrame:
    """Add an id that is unique across sources, from the row's own id or else from its content."""
    content = F.md5(F.to_json(F.struct(*sorted(c for c in table.columns if c != "split")), {"ignoreNullFields": "false"}))
    own = F.col("id").cast("string") if "id" in table.columns else content
    return table.withColumn("id", F.concat_ws(":", F.lit(source), "split", own))


@dataclass(frozen=True)
class Stores:
    """Folders of the stage outputs below one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def prepare_sft(
    spark: SparkSession,
    catalog: Catalog,
    root: str,
    normalizers: Mapping[str, Normalizer] = SOURCES,
    lexicon: Lexicon = CLINICAL_LEXICON,
    target: int = K.SFT_TARGET_ROWS,
    recognizers: Sequence[Recognizer] = DEFAULT_RECOGNIZERS,
    model_factory: Callable[[], SpanModel] | None = None,
    seed: int = K.SEED,
    overwrite: bool = False,
    skip_failed: bool = False,
) -> dict[str, DataFrame]:
    """Catalog to stored final splits, reusing every stage that is already complete.

    Ids are prefixed with the names of source and split; where a source has none, the digest of
    the row takes its place, so equal rows share an id until deduplication leaves one of them.
    A source or split that cannot be loaded stops the job; with ``skip_failed`` the job goes on
    without it.  What happened to each source is stored beside the first stage and returned as
    ``outcomes``.
    """
    at = Stores(root)

    def raw() -> DataFrame:
        tables, outcome = load_all(spark, catalog, [n for n in normalizers if n in catalog], skip_failed)
        outcome.write.mode("overwrite").parquet(at.sft_outcomes)
        failed = [f"{r['name']}: {r['error']}" for r in outcome.where("NOT ok").toLocalIterator()]
        if failed and not skip_failed:
            raise RuntimeError("sources failed to load: " + "; ".join(failed))
        rows = union_sources({n: with_row_id(t, n) for n, t in tables.items()}, normalizers)
        return dedup_pair(label_rows(rows, lexicon))

    unique = run_stage(spark, at.sft_unique, raw, overwrite)
    balanced = run_stage(
        spark, at.sft_raw, lambda: balance_classes(unique, target=target, seed=seed), overwrite
    )
    masked = run_stage(
        spark, at.sft_anonymized,
        lambda: pii.anonymize(
            balanced, SFT_TEXT, recognizers=recognizers, model_factory=model_factory
        ),
        overwrite,
    )

    single = run_stage(
        spark, at.sft_single, lambda: dedup_key(masked.drop("entities"), "instruction"), overwrite
    )
    final = run_stage(
        spark, at.sft_final, lambda: stratified_split(single, seed=seed), overwrite, partition_by=["split"]
    )
    outcomes = spark.read.parquet(at.sft_outcomes)
    return {"sft_raw": balanced, "sft_anonymized": masked, "sft": final, "outcomes": outcomes}


def prepare_pairs(
    spark: SparkSession,
    sft_raw: DataFrame,
    root: str,
    hard: DataFrame | None = None,
    target: int = K.PAIR_TARGET_ROWS,
    recognizers: Sequence[Recognizer] = DEFAULT_RECOGNIZERS,
    model_factory: Callable[[], SpanModel] | None = None,
    seed: int = K.SEED,
    overwrite: bool = False,
) -> dict[str, DataFrame]:
    """Labelled rows, and optionally hard negatives, to stored final pair splits.

    After new hard negatives are mined, run it with ``overwrite`` to rebuild all of it.
    """
    at = Stores(root)
    made = run_stage(
        spark, at.dpo_raw, lambda: preference_dataset(sft_raw, hard, target, seed), overwrite
    )
    masked = run_stage(
        spark, at.dpo_anonymized,
        lambda: pii.anonymize(
            made, PAIR_TEXT, recognizers=recognizers, model_factory=model_factory
        ),
        overwrite,
    )
    final = run_stage(
        spark, at.dpo_final,
        lambda: random_split(masked.drop("entities"), row_id="pair_id", seed=seed),
        overwrite, partition_by=["split"],
    )
    return {"dpo_raw": made, "dpo_anonymized": masked, "dpo": final}


def check_sft(final: DataFrame, minimum: Mapping[str, int] = K.MIN_SPLIT_ROWS) -> DataFrame:
    """All gates over the final table, rolled up."""
    lost = gates.missing_columns(final, K.SFT_COLUMNS)
    if lost:
        raise ValueError(f"missing columns: {lost}")
    sizes = gates.split_size_gate(final, minimum=minimum)
    shared = gates.leakage_check(final, "instruction")
    empty = gates.null_check(final, K.SFT_COLUMNS)
    gap = gates.class_gap(final, "urgency_level", ["split"])
    return gates.gate_rollup(
        [
            gates.gate_row(empty, "schema", gates.BLOCK, F.col("n_empty") == 0, F.col("column_name")),
            gates.gate_row(sizes, "split_size", gates.BLOCK, F.col("passed"), F.col("split")),
            gates.gate_row(
                shared, "leakage", gates.BLOCK, F.col("n_shared") == 0,
                F.concat_ws("|", "left_split", "right_split"),
            ),
            gates.gate_row(gap, "class_gap", gates.WARN, F.col("passed"), F.col("split")),
        ]
    )


def check_pairs(final: DataFrame) -> DataFrame:
    """All gates over the final pairs, rolled up."""
    lost = gates.missing_columns(final, K.DPO_COLUMNS)
    if lost:
        raise ValueError(f"missing columns: {lost}")
    empty = gates.null_check(final, K.DPO_COLUMNS)
    same = gates.identical_pairs(final, ["split"])
    return gates.gate_rollup(
        [
            gates.gate_row(empty, "schema", gates.BLOCK, F.col("n_empty") == 0, F.col("column_name")),
            gates.gate_row(same, "identical_pairs", gates.BLOCK, F.col("n_identical") == 0, F.col("split")),
        ]
    )


def statistics_tables(sft: DataFrame, dpo: DataFrame) -> dict[str, DataFrame]:
    """The tables of the statistics report."""
    return {
        "SFT splits": stats.split_stats(sft, SFT_TEXT),
        "SFT distributions": stats.split_dist(sft, ["urgency_level", "source", "language"]),
        "Pair splits": stats.split_stats(dpo, PAIR_TEXT),
    }
