"""Queries: sampling, balancing, splitting, preference pairs, validation gates."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import fingerprint, seeded_key
from corpusloom.operators import dedup, evaluation, gates, pairs, sampling, stats
from corpusloom.operators.labeling import label_by_lexicon
from corpusloom.queries import bindings as B
from corpusloom.queries.bindings import q
from corpusloom.session import shared_folder
from corpusloom.sources.stages import run_stage

KEY = B.sql_key(K.SEED, "id")
PAIR_TARGET = 150


# --- sampling -------------------------------------------------------------------------------


def balance_classes(spark, folder):
    rows = B.level_only(spark, folder)
    return sampling.balance_classes(rows, target=600)


BALANCE_SQL = f"""
WITH {B.LEVELLED_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY urgency_level ORDER BY {KEY}) AS r FROM levelled)
SELECT id, urgency_level, source, language FROM ranked WHERE r <= 200"""


def stratified_sample(spark, folder):
    """An equal share of every source; there are as many strata as sources."""
    return sampling.stratified_sample(B.sft_like(spark, folder), label="source", target=300)


STRATIFIED_SQL = f"""
WITH {B.SFT_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY {KEY}) AS r FROM sft)
SELECT id, instruction, raw_response, source, language FROM ranked
WHERE r <= 300 // (SELECT count(DISTINCT source) FROM sft)"""


def cap_sample(spark, folder):
    return sampling.cap_sample(B.sft_like(spark, folder), 100)


def sample_per_language(spark, folder):
    rows = B.sft_like(spark, folder).select("id", "language", "source")
    return sampling.sample_per_group(rows, F.col("language"), 25)


def seeded_shuffle(spark, folder):
    """The whole table in seeded order; positions are implied by the key, which is returned."""
    rows = B.sft_like(spark, folder).select("id", "source")
    return sampling.shuffled(rows).withColumn("shuffle_key", seeded_key(K.SEED, F.col("id")))


def _split_rows(spark, folder):
    return sampling.stratified_split(B.level_only(spark, folder))


def stratified_split(spark, folder):
    return _split_rows(spark, folder).select("id", "urgency_level", "split")


# Row counts per class and split: two successive splits, each shared by largest remainder.
_TEST = 1.0 - 0.8 - 0.1
SPLIT_SQL = f"""
{{rows}},
sizes AS (SELECT urgency_level AS c, count(*)::HUGEINT AS n FROM levelled GROUP BY 1),
one AS (SELECT *, sum(n) OVER () AS total,
               sum(n) OVER () - ceil({0.1 + _TEST!r}::DOUBLE * sum(n) OVER ())::HUGEINT AS draws
        FROM sizes),
two AS (SELECT *, n * draws // total AS base, n * draws % total AS rest FROM one),
three AS (SELECT *, draws - sum(base) OVER () AS open,
                 row_number() OVER (ORDER BY rest DESC, c) AS place FROM two),
four AS (SELECT c, n, base + CASE WHEN place <= open THEN 1 ELSE 0 END AS train FROM three),
five AS (SELECT *, n - train AS left_over, sum(n - train) OVER () AS total,
                sum(n - train) OVER ()
                  - ceil({_TEST / (0.1 + _TEST)!r}::DOUBLE * sum(n - train) OVER ())::HUGEINT AS draws
         FROM four),
six AS (SELECT *, left_over * draws // total AS base, left_over * draws % total AS rest FROM five),
seven AS (SELECT *, draws - sum(base) OVER () AS open,
                 row_number() OVER (ORDER BY rest DESC, c) AS place FROM six),
shares AS (SELECT c, train, base + CASE WHEN place <= open THEN 1 ELSE 0 END AS val FROM seven),
ranked AS (SELECT *, row_number() OVER (PARTITION BY urgency_level ORDER BY {KEY}) AS r
           FROM levelled),
splitted AS (SELECT ranked.*, CASE WHEN r <= train THEN 'train' WHEN r <= train + val THEN 'val'
                              ELSE 'test' END AS split
             FROM ranked JOIN shares ON shares.c = ranked.urgency_level)"""
LEVEL_SPLIT_SQL = SPLIT_SQL.format(rows=f"WITH {B.LEVELLED_SQL}")


def random_split(spark, folder):
    rows = sampling.random_split(B.sft_like(spark, folder).select("id", "instruction"))
    return rows.select("id", "split")


RANDOM_SPLIT_SQL = f"""
WITH {B.SFT_SQL}, ranked AS (
  SELECT *, row_number() OVER (ORDER BY {KEY}) AS r, count(*) OVER () AS n FROM sft),
splitted AS (
  SELECT *, CASE WHEN r <= n - ceil({1.0 - 0.9!r}::DOUBLE * n)::BIGINT THEN 'train' ELSE 'val' END
              AS split
  FROM ranked)"""


def good_bad_examples(spark, folder):
    base = B.predictions(spark, folder, ("base",))
    return evaluation.good_bad_examples(base, 10).select(
        "id", "reference_urgency", "predicted_urgency", "is_correct"
    )


def profile_source(spark, folder):
    rows = B.sft_like(spark, folder).withColumnRenamed("language", "split")
    return stats.profile_source(rows, "id").select("split", "n_rows", "id", "instruction", "source")


# --- preference pairs -------------------------------------------------------------------------


def synthetic_pairs(spark, folder):
    return pairs.synthetic_pairs(B.sft_labelled(spark, folder))


_WRONG = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in K.WRONG_LEVEL.items())
SYNTHETIC_SQL = f"""
  SELECT id, instruction AS prompt, response AS chosen,
         {B.sql_answer("wrong", "body")} AS rejected, {q(K.SOURCE_SYNTHETIC)} AS source, language
  FROM (SELECT *, CASE urgency_level {_WRONG} END AS wrong, {B.sql_body("response")} AS body
        FROM {{rows}})"""


def _hard(spark, folder, rows=None):
    truth = B.truth(spark, folder, rows)
    answered = truth.withColumn(
        "response", B.render_answer(F.col("urgency_level"), F.col("raw_response"))
    )
    return pairs.hard_negatives(answered, B.generations(truth))


def hard_negatives(spark, folder):
    return _hard(spark, folder)


HARD_SQL = f"""
  SELECT id, instruction AS prompt, response AS chosen, made AS rejected,
         {q(K.SOURCE_HARD_NEGATIVE)} AS source, language
  FROM (SELECT *, {B.sql_answer("urgency_level", "raw_response")} AS response FROM (
          SELECT *, {B.sql_generation("voted")} AS made FROM (
            SELECT *, {B.sql_level("instruction || ' ' || raw_response")} AS voted FROM truth)))
  WHERE made <> '' AND ({B.sql_parse("made")}) <> urgency_level"""


def _both_kinds(spark, folder):
    """Synthetic pairs of all documents and the hard negatives."""
    rows = B.sft_like(spark, folder)
    made = pairs.synthetic_pairs(B.sft_labelled(spark, folder, rows))
    return made.unionByName(_hard(spark, folder, rows))


def dedup_priority(spark, folder):
    both = _both_kinds(spark, folder)
    keyed = both.withColumn("pair_id", F.concat_ws(":", "source", "id"))
    return dedup.dedup_by_priority(keyed, row_id="pair_id")


def _sql_priority(rows: str, row_id: str, name: str) -> str:
    level = B.sql_parse("chosen")
    return f"""{name} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY prompt
      ORDER BY CASE ({level}) WHEN 'max' THEN 2 WHEN 'moderate' THEN 1 ELSE 0 END DESC,
               {B.sql_key(K.SEED, row_id)}) AS place
    FROM {rows})
  WHERE place = 1)"""


TRUTH_TAIL = B.TRUTH_SQL.replace(B.SFT_SQL + ",", "")
PRIORITY_SQL = f"""
WITH {B.LABELLED_SQL}, {TRUTH_TAIL},
both_kinds AS (
  {SYNTHETIC_SQL.format(rows="labelled")} UNION ALL {HARD_SQL}),
keyed AS (SELECT *, source || ':' || id AS pair_id FROM both_kinds),
{_sql_priority("keyed", "pair_id", "kept")}
SELECT * FROM kept"""


def preference_dataset(spark, folder):
    rows = B.sft_like(spark, folder)
    labelled = B.sft_labelled(spark, folder, rows)
    return pairs.preference_dataset(labelled, _hard(spark, folder, rows), target=PAIR_TARGET)


PREFERENCE_SQL = f"""
WITH {B.LABELLED_SQL}, {TRUTH_TAIL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY urgency_level ORDER BY {KEY}) AS r
           FROM labelled),
sampled AS (SELECT * FROM ranked
            WHERE r <= {PAIR_TARGET} // (SELECT count(DISTINCT urgency_level) FROM labelled)),
made_pairs AS ({SYNTHETIC_SQL.format(rows="sampled")}),
{_sql_priority("made_pairs", "id", "first_kept")},
hard AS ({HARD_SQL}),
capped AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (ORDER BY {KEY}) AS r FROM hard) WHERE r <= {PAIR_TARGET}),
merged AS (SELECT *, source || ':' || id AS pair_id
           FROM (SELECT * FROM first_kept UNION ALL SELECT * FROM capped)),
{_sql_priority("merged", "pair_id", "kept")}
SELECT * FROM kept"""


def pair_label_hist(spark, folder):
    both = _both_kinds(spark, folder)
    return pairs.pair_label_counts(both)


PAIR_HIST_SQL = f"""
WITH {B.LABELLED_SQL}, {TRUTH_TAIL},
both_kinds AS ({SYNTHETIC_SQL.format(rows="labelled")} UNION ALL {HARD_SQL}),
sides AS (SELECT 'chosen' AS side, {B.sql_parse("chosen")} AS level FROM both_kinds
          UNION ALL SELECT 'rejected', {B.sql_parse("rejected")} FROM both_kinds)
SELECT side, coalesce(level, 'unknown') AS level, count(*) AS n FROM sides GROUP BY ALL"""


# --- gates --------------------------------------------------------------------------------------


def null_check(spark, folder):
    rows = B.sft_labelled(spark, folder).withColumn(
        "confidence", F.when(F.col("language") == "de", 0.0).otherwise(F.col("confidence"))
    )
    return gates.null_check(rows, [*K.SFT_COLUMNS, "raw_response"])


NULL_SQL = f"""
WITH {B.LABELLED_SQL}, rows AS (
  SELECT * REPLACE (CASE WHEN language = 'de' THEN 0.0::DOUBLE ELSE confidence END AS confidence)
  FROM labelled)
SELECT column_name, n_empty FROM (
  SELECT {", ".join(f"count(*) FILTER (coalesce({c}, '') = '') AS {c}"
                    for c in K.SFT_COLUMNS if c != "confidence")},
         count(*) FILTER (coalesce(raw_response, '') = '') AS raw_response,
         count(*) FILTER (coalesce(confidence, 0) = 0) AS confidence
  FROM rows)
UNPIVOT (n_empty FOR column_name IN ({", ".join(K.SFT_COLUMNS)}, raw_response))"""


def leakage_check(spark, folder):
    """Copies shared between splits, when the table is split before and after removing them."""
    rows = B.sft_like(spark, folder).withColumn("urgency_level", F.col("language"))
    before = sampling.stratified_split(rows, label="language")
    after = sampling.stratified_split(
        dedup.dedup_key(rows, "instruction"), label="language"
    )
    checked = gates.leakage_check(before, "instruction").withColumn("stage", F.lit("before"))
    return checked.unionByName(
        gates.leakage_check(after, "instruction").withColumn("stage", F.lit("after"))
    )


def _sql_shared(stage: str, name: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS left_split, '{b}' AS right_split,
            (SELECT count(*) FROM (SELECT instruction FROM {name} WHERE split = '{a}'
                    INTERSECT SELECT instruction FROM {name} WHERE split = '{b}')) AS n_shared,
            '{stage}' AS stage"""
        for a, b in [("train", "val"), ("train", "test"), ("val", "test")]
    )


def _sql_language_split(rows: str, prefix: str) -> str:
    """The split CTEs of ``SPLIT_SQL`` over another table, with prefixed names."""
    text = SPLIT_SQL.split("{rows},", 1)[1]
    for name in ["sizes", "one", "two", "three", "four", "five", "six", "seven", "shares",
                 "ranked", "splitted"]:
        text = _rename(text, name, f"{prefix}_{name}")
    return _rename(text, "levelled", rows).replace("urgency_level", "language")


def _rename(text: str, name: str, new: str) -> str:
    return re.sub(rf"\b{name}\b", new, text)


LEAK_SQL = f"""
WITH {B.SFT_SQL},
firsts AS (SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY instruction ORDER BY id) AS place FROM sft)
  WHERE place = 1),
{_sql_language_split("sft", "b").strip()},
{_sql_language_split("firsts", "a").strip()}
{_sql_shared("before", "b_splitted")} UNION ALL {_sql_shared("after", "a_splitted")}"""


def leaking_rows(spark, folder):
    """The training rows whose instruction also occurs among the validation rows."""
    rows = sampling.random_split(B.sft_like(spark, folder).select("id", "instruction"))
    return gates.leaking_rows(rows, "instruction", from_split="val")


def class_gap(spark, folder):
    return gates.class_gap(_split_rows(spark, folder), "urgency_level", ["split"])


CLASS_GAP_SQL = f"""{LEVEL_SPLIT_SQL},
counted AS (SELECT split, urgency_level, count(*) AS n FROM splitted GROUP BY ALL),
gaps AS (SELECT split, max(n)::DOUBLE / sum(n) * 100 - min(n)::DOUBLE / sum(n) * 100 AS gap_pct
         FROM counted GROUP BY split)
SELECT split, gap_pct, gap_pct <= 10.0 AS passed FROM gaps"""


def split_size_gate(spark, folder):
    return gates.split_size_gate(_split_rows(spark, folder))


SIZE_SQL = f"""{LEVEL_SPLIT_SQL},
required AS (SELECT * FROM (VALUES ('train', 4000), ('val', 500), ('test', 500)) AS t(split, minimum))
SELECT split, (SELECT count(*) FROM splitted s WHERE s.split = required.split) AS n,
       minimum::BIGINT AS minimum,
       (SELECT count(*) FROM splitted s WHERE s.split = required.split) >= minimum AS passed
FROM required"""


def identical_pairs(spark, folder):
    both = _both_kinds(spark, folder)
    return gates.identical_pairs(both, ["source"])


def gate_rollup(spark, folder):
    """All gates over a stored split table, rolled up."""
    text = B.sft_like(spark, folder)
    levels = label_by_lexicon(text, lexicon=B.LEXICON).select(
        "id", "urgency_level", "source", "language", fingerprint(F.col("instruction")).alias("mark")
    )
    path = os.path.join(shared_folder(spark), "stages", uuid.uuid4().hex)
    rows = run_stage(spark, path, lambda: sampling.stratified_split(levels))
    sizes = gates.split_size_gate(rows)
    shared = gates.leakage_check(rows, "mark")
    empty = gates.null_check(rows, ["urgency_level", "source", "language"])
    gap = gates.class_gap(rows, "urgency_level", ["split"])
    return gates.gate_rollup(
        [
            gates.gate_row(sizes, "split_size", gates.BLOCK, F.col("passed"),
                           F.concat_ws("=", "split", "n")),
            gates.gate_row(shared, "leakage", gates.BLOCK, F.col("n_shared") == 0,
                           F.concat_ws("|", "left_split", "right_split", "n_shared")),
            gates.gate_row(empty, "schema", gates.BLOCK, F.col("n_empty") == 0,
                           F.concat_ws("=", "column_name", "n_empty")),
            gates.gate_row(gap, "class_gap", gates.WARN, F.col("passed"), F.col("split")),
        ]
    )


ROLLUP_SQL = f"""{LEVEL_SPLIT_SQL},
required AS (SELECT * FROM (VALUES ('train', 4000), ('val', 500), ('test', 500)) AS t(split, minimum)),
found AS (SELECT split, minimum, (SELECT count(*) FROM splitted s WHERE s.split = required.split) AS n
          FROM required),
{{leaks}},
counted AS (SELECT split, urgency_level, count(*) AS n FROM splitted GROUP BY ALL),
gates AS (
  SELECT 'split_size' AS gate, 'block' AS severity, n >= minimum AS passed, split || '=' || n AS detail
  FROM found
  UNION ALL SELECT 'leakage', 'block', n_shared = 0,
                   left_split || '|' || right_split || '|' || n_shared FROM leaks
  UNION ALL SELECT 'schema', 'block', n = 0, c || '=' || n FROM (
    SELECT 'urgency_level' AS c, count(*) FILTER (coalesce(urgency_level, '') = '') AS n FROM splitted
    UNION ALL SELECT 'source', count(*) FILTER (coalesce(source, '') = '') FROM splitted
    UNION ALL SELECT 'language', count(*) FILTER (coalesce(language, '') = '') FROM splitted)
  UNION ALL SELECT 'class_gap', 'warn', max(n)::DOUBLE / sum(n) * 100 - min(n)::DOUBLE / sum(n) * 100 <= 10,
                   split FROM counted GROUP BY split)
SELECT * FROM gates
UNION ALL
SELECT 'overall', 'block', bool_and(passed) FILTER (severity = 'block'),
       (count(*) FILTER (severity = 'block' AND NOT passed))::VARCHAR FROM gates"""
ROLLUP_SQL = ROLLUP_SQL.format(leaks=f"leaks AS ({_sql_shared('now', 'splitted')})")


QUERIES = {
    "balance_classes": (balance_classes, BALANCE_SQL),
    "stratified_sample": (stratified_sample, STRATIFIED_SQL),
    "cap_sample": (
        cap_sample,
        f"""WITH {B.SFT_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY {KEY}) AS r FROM sft)
            SELECT id, instruction, raw_response, source, language FROM ranked WHERE r <= 100""",
    ),
    "sample_per_language": (
        sample_per_language,
        f"""WITH {B.SFT_SQL}, ranked AS (
              SELECT *, row_number() OVER (PARTITION BY language ORDER BY {KEY}) AS r FROM sft)
            SELECT id, language, source FROM ranked WHERE r <= 25""",
    ),
    "seeded_shuffle": (
        seeded_shuffle,
        f"SELECT doc_id AS id, source, {B.sql_key(K.SEED, 'doc_id')} AS shuffle_key FROM documents",
    ),
    "stratified_split": (
        stratified_split, f"{LEVEL_SPLIT_SQL} SELECT id, urgency_level, split FROM splitted",
    ),
    "random_split": (random_split, f"{RANDOM_SPLIT_SQL} SELECT id, split FROM splitted"),
    "good_bad_examples": (
        good_bad_examples,
        f"""WITH {B.PREDICTIONS_SQL}, flagged AS (
              SELECT *, coalesce(predicted_urgency = reference_urgency, FALSE) AS is_correct
              FROM preds WHERE model = 'base'),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY is_correct ORDER BY {KEY}) AS r
                       FROM flagged)
            SELECT id, reference_urgency, predicted_urgency, is_correct FROM ranked WHERE r <= 5""",
    ),
    "profile_source": (
        profile_source,
        f"""WITH {B.SFT_SQL}, ranked AS (
              SELECT *, row_number() OVER (PARTITION BY language ORDER BY {KEY}) AS r,
                     count(*) OVER (PARTITION BY language) AS n_rows FROM sft)
            SELECT language AS split, n_rows, id, instruction, source FROM ranked WHERE r <= 2""",
    ),
    "synthetic_pairs": (
        synthetic_pairs, f"WITH {B.LABELLED_SQL} {SYNTHETIC_SQL.format(rows='labelled')}",
    ),
    "hard_negatives": (hard_negatives, f"WITH {B.TRUTH_SQL} {HARD_SQL}"),
    "dedup_priority": (dedup_priority, PRIORITY_SQL),
    "preference_dataset": (preference_dataset, PREFERENCE_SQL),
    "pair_label_hist": (pair_label_hist, PAIR_HIST_SQL),
    "null_check": (null_check, NULL_SQL),
    "leakage_check": (leakage_check, LEAK_SQL),
    "leaking_rows": (
        leaking_rows,
        f"""{RANDOM_SPLIT_SQL}
            SELECT id, instruction, split FROM splitted WHERE split = 'train'
              AND instruction IN (SELECT instruction FROM splitted WHERE split = 'val')""",
    ),
    "class_gap": (class_gap, CLASS_GAP_SQL),
    "split_size_gate": (split_size_gate, SIZE_SQL),
    "identical_pairs": (
        identical_pairs,
        f"""WITH {B.LABELLED_SQL}, {TRUTH_TAIL},
            both_kinds AS ({SYNTHETIC_SQL.format(rows="labelled")} UNION ALL {HARD_SQL})
            SELECT source, count(*) AS n_pairs,
                   count(*) FILTER (chosen IS NOT DISTINCT FROM rejected) AS n_identical
            FROM both_kinds GROUP BY source""",
    ),
    "gate_rollup": (gate_rollup, ROLLUP_SQL),
}
