"""Statistics, chat formats, evaluation and request logs."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import chat, evaluation, requests, scoring, stats

SYSTEM = "be kind"


def test_value_counts_and_shares(rows, values):
    df = rows([("t", "a", "x"), ("t", "a", "y"), ("v", "b", None)], "split string, c string, d string")
    assert values(stats.value_counts(df, ["c", "d"])) == [
        ("c", "a", 2), ("c", "b", 1), ("d", "x", 1), ("d", "y", 1), ("d", None, 1),
    ]
    shares = {(s, c, v): p for s, c, v, n, p in values(stats.split_dist(df, ["c", "d"]), "split", "column_name", "value", "n", "pct")}
    assert shares["t", "d", "x"] == 50.0 and shares["t", "c", "a"] == 100.0


def test_split_stats(rows, values):
    df = rows([("t", "a b c", ""), ("t", "a", None), ("v", " ", "x y")], "split string, p string, q string")
    assert values(stats.split_stats(df, ["p", "q"])) == [("t", 2, 2.0, 0.0), ("v", 1, 0.0, 2.0)]


@pytest.mark.parametrize("lengths", [[1, 2, 3, 10], [7], list(range(1, 2001)), [600] * 5 + [5]])
def test_length_profile(spark, lengths):
    import numpy as np

    df = spark.createDataFrame([(n,) for n in lengths], "n_tokens int")
    got = stats.length_profile(df, limit=512).first().asDict()
    for p in stats.PERCENTILES:
        assert got[f"p{p}"] == int(np.percentile(lengths, p))
    over = sum(n > 512 for n in lengths)
    assert (got["max_len"], got["n_truncated"]) == (max(lengths), over)
    assert got["mean_len"] == pytest.approx(statistics.mean(lengths))
    assert got["pct_truncated"] == pytest.approx(round(over / len(lengths) * 100, 2))
    p95 = got["p95"]
    assert got["advised_length"] == (512 if p95 <= 512 else 1024 if p95 <= 1024 else 2048)


def test_token_length_with_a_tokenizer(rows, values):
    df = rows([(1, "a b"), (2, "")], "id int, t string")
    assert values(stats.with_token_length(df, F.col("t")), "id", "n_tokens") == [(1, 2), (2, 0)]
    counted = stats.with_token_length(df, F.col("t"), tokenizer_factory=lambda: lambda texts: [len(t) for t in texts])
    assert values(counted, "id", "n_tokens") == [(1, 3), (2, 0)]


def test_profile_source(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 99, "a").otherwise("b"))
    got = stats.profile_source(df, "id").collect()
    assert sorted((r.split, r.n_rows) for r in got) == [("a", 99), ("a", 99), ("b", 1)]


# --- chat -------------------------------------------------------------------------------------


def render(messages, open_answer=False):
    text = "".join(f"<|im_start|>{role}\n{content}<|im_end|>\n" for role, content in messages)
    return text + ("<|im_start|>assistant\n" if open_answer else "")


def test_prompt_and_completion_make_the_conversation(rows):
    df = rows([(1, "q\nq", "a <b>", "max")], "id int, instruction string, response string, urgency_level string")
    r = chat.chat_format(df, system=SYSTEM).first()
    asked = [("system", SYSTEM), ("user", "q\nq")]
    assert r.prompt == render(asked, open_answer=True)
    assert r.prompt + r.completion == r.text == render([*asked, ("assistant", "a <b>")])
    assert r.urgency_level == "max"
    assert chat.inference_prompts(df, system=SYSTEM).first().prompt == r.prompt + "<think>\n\n</think>\n"


def test_pairs_and_legacy(rows):
    df = rows([(1, "p", "c", "r")], "id int, prompt string, chosen string, rejected string")
    r = chat.chat_format_pairs(df, system=SYSTEM).first()
    assert (r.prompt, r.chosen, r.rejected) == (
        render([("system", SYSTEM), ("user", "p")], True), "c<|im_end|>\n", "r<|im_end|>\n",
    )
    old = "<|im_start|>system\nbe kind\n<|im_end|>\n<|im_start|>user\np\n<|im_end|>\n<|im_start|>assistant\n"
    r = chat.chat_format_pairs_legacy(df, system=SYSTEM).first()
    assert (r.prompt, r.chosen, r.rejected) == (old, "c<|im_end|>", "r<|im_end|>")
    one = rows([(1, "p", "c"), (2, "p", "")], "id int, instruction string, response string")
    texts = {x.id: x.text for x in chat.chat_format_legacy(one, system=SYSTEM).collect()}
    assert texts == {1: old + "c<|im_end|>", 2: old}


def test_site_goes_into_the_system_prompt():
    assert "pour le Hôpital Test." in K.system_prompt("Hôpital Test") and "{site}" not in K.system_prompt()


def test_conversations_of_any_length(rows, values):
    data = [(1, 2, "assistant", "c"), (1, 0, "system", "a"), (1, 1, "user", "b"), (2, 0, "user", "z")]
    df = rows(data, "conv_id int, turn bigint, role string, text string")
    whole = render([("system", "a"), ("user", "b"), ("assistant", "c")])
    assert values(chat.render_conversations(df)) == [(1, 3, whole), (2, 1, render([("user", "z")]))]
    parts = sorted(chat.render_conversations(df, turns_per_part=2).where("conv_id = 1").collect(), key=lambda r: r.part)
    assert len(parts) == 2 and "".join(p.text for p in parts) == whole


# --- evaluation -----------------------------------------------------------------------------------

PUBLISHED = {("max", "max"): 146, ("max", "moderate"): 15, ("max", "deferred"): 25,
             ("moderate", "max"): 72, ("moderate", "moderate"): 97, ("moderate", "deferred"): 25,
             ("deferred", "max"): 35, ("deferred", "moderate"): 29, ("deferred", "deferred"): 125}
PRED = "id int, reference_urgency string, predicted_urgency string, generated_response string, format_ok boolean"


def expand(matrix):
    cells = [cell for cell, n in matrix.items() for _ in range(n)]
    return [(i, a, b, "one two three", i % 4 != 0) for i, (a, b) in enumerate(cells)]


def reference_metrics(pairs):
    parsed = [(t, p) for t, p in pairs if p is not None]
    recalls, f1s, f2s = [], [], []
    for label in K.LEVELS:
        hit = sum(t == p == label for t, p in parsed)
        actual, predicted = sum(t == label for t, _ in parsed), sum(p == label for _, p in parsed)
        recall, precision = (hit / actual if actual else 0.0), (hit / predicted if predicted else 0.0)
        recalls.append(recall)
        for beta, out in ((1, f1s), (2, f2s)):
            below = beta**2 * precision + recall
            out.append((1 + beta**2) * precision * recall / below if below else 0.0)
    accuracy = sum(t == p for t, p in parsed) / len(parsed) if parsed else 0.0
    mean = lambda xs: sum(xs) / 3
    return [round(x, 4) for x in (accuracy, mean(f1s), mean(recalls), recalls[0], mean(f2s))]


def test_published_matrix(rows, values):
    df = rows(expand(PUBLISHED), PRED)
    m = evaluation.evaluate(df).first()
    assert (m.accuracy, m.recall_max, m.recall_macro, m.f1_macro, m.f2_macro) == (0.6467, 0.7849, 0.6488, 0.6437, 0.6441)
    assert (m.n_evaluated, m.n_unparseable, m.response_length_mean) == (569, 0, 3.0)
    assert {(a, b): n for a, b, n in values(evaluation.confusion_matrix(df))} == PUBLISHED
    recall = dict(values(evaluation.per_class_metrics(df), "label", "recall"))
    assert recall == {"max": 0.7849, "moderate": 0.5, "deferred": 0.6614}


@pytest.mark.parametrize("pairs", [
    [("max", "max"), ("moderate", "max"), ("max", None)],
    [("max", None), ("deferred", None)],
    [("max", "max")] * 3,
    [("max", "deferred"), ("moderate", "max"), ("deferred", "moderate")],
    [("other", "max"), ("max", "max"), ("moderate", "moderate")],
])
def test_metrics_of_small_tables(rows, pairs):
    df = rows([(i, t, p, "w", True) for i, (t, p) in enumerate(pairs)], PRED)
    m = evaluation.evaluate(df).first()
    assert [m.accuracy, m.f1_macro, m.recall_macro, m.recall_max, m.f2_macro] == reference_metrics(pairs)
    assert m.n_unparseable == sum(p is None for _, p in pairs)


def test_empty_table(rows):
    m = evaluation.evaluate(rows([], PRED)).first()
    assert (m.accuracy, m.format_compliance, m.n_evaluated) == (0.0, 0.0, 0)


def test_prediction_table(rows, values):
    truth = rows([(1, "q", "max"), (2, "q", "max"), (3, "q", "max")], "id int, instruction string, urgency_level string")
    made = rows([(1, "URGENCE MAXIMALE. abcdefghijk. abcdefghijk"), (2, "?")], "id int, generated_response string")
    got = evaluation.prediction_table(truth, made)
    assert values(got, "id", "predicted_urgency", "format_ok") == [(1, "max", True), (2, None, False), (3, None, False)]


def test_thresholds_compare_and_verdict(rows, values):
    metrics = rows([("a", 0.65, 0.6, 0.6, 0.8, 0.61, 0.7), ("b", 0.62, 0.6, 0.6, 0.74, 0.59, 0.71)],
                   "model string, accuracy double, f1_macro double, recall_macro double, recall_max double, f2_macro double, format_compliance double")
    checks = evaluation.threshold_check(metrics, by=["model"])
    assert values(evaluation.count_passed(checks, ["model"])) == [("a", 4, 4), ("b", 2, 4)]
    assert values(evaluation.threshold_check(metrics.select("model"), {"x": 0.1}), "value", "passed") == [(0.0, False)] * 2
    deltas = {r.metric: (r.delta, r.candidate_passed) for r in evaluation.compare_models(metrics, "a", "b").collect()}
    assert deltas["accuracy"] == (pytest.approx(-0.03), True) and deltas["recall_max"] == (pytest.approx(-0.06), False)
    assert deltas["f1_macro"] == (0.0, None)


@pytest.mark.parametrize("base,candidate,verdict", [
    (0.65, 0.65, "validated"), (0.7, 0.68, "validated"), (0.7, 0.66, "mixed"), (0.6, 0.64, "mixed"), (0.7, 0.6, "regression"),
])
def test_verdict(rows, base, candidate, verdict):
    metrics = rows([("a", base), ("b", candidate)], "model string, accuracy double")
    got = evaluation.model_verdict(metrics, "a", "b").first()
    assert got.candidate_verdict == verdict
    assert got.base_verdict == ("ready" if base >= 0.7 else "acceptable" if base >= 0.6 else "insufficient")


def test_good_and_bad_examples(rows):
    df = rows([(i, "max", "max" if i < 50 else None if i < 70 else "deferred", "w", True) for i in range(100)], PRED)
    got = evaluation.good_bad_examples(df, 10).collect()
    assert sorted(r.is_correct for r in got) == [False] * 5 + [True] * 5
    assert all(r.is_correct == (r.id < 50) for r in got)


def test_paired_responses(spark):
    table = spark.range(50).select("id", F.concat(F.lit("p"), "id").alias("prompt"), F.lit("c").alias("chosen"))
    made = table.select("id", F.concat(F.lit("m"), "id").alias("generated_response"))
    got = evaluation.paired_responses(table, made, made, n=7).collect()
    assert len(got) == 7 and all(r.first_response == f"m{r.id}" == r.second_response and r.prompt == f"p{r.id}" for r in got)


def test_throughput(rows, values):
    df = rows([(100, 30.0), (5, 0.0)], "n_evaluated int, duration_s double")
    assert values(evaluation.throughput(df), "examples_per_min") == [(0.0,), (200.0,)]


def test_scorer_failures_leave_empty_texts(spark):
    def factory():
        def score(texts):
            if "bad" in texts:
                raise RuntimeError("no memory")
            return [t.upper() for t in texts]

        return score

    df = spark.createDataFrame([(i, "bad" if i == 5 else "ok") for i in range(8)], "id int, t string").coalesce(1)
    got = {r.id: (r.generated_response, r.score_error) for r in scoring.score_table(df, "t", factory, batch_size=4).collect()}
    assert [got[i] for i in range(4)] == [("OK", None)] * 4
    assert [got[i] for i in range(4, 8)] == [("", "no memory")] * 4


# --- requests ------------------------------------------------------------------------------------------

LOG = "phase string, latency_ms double, error string"


def expected(latencies):
    s, n = sorted(latencies), len(latencies)
    at = lambda p: s[min(int(p / 100 * n), n - 1)]
    return [round(x, 1) for x in (s[0], s[-1], statistics.mean(s), statistics.median(s), at(95), at(99))]


@pytest.mark.parametrize("latencies", [
    [float(i) for i in range(1, 21)], [3.0], [1.0, 2.0], [5.0] * 9 + [80.0], [math.sqrt(i) * 10 for i in range(777)],
])
def test_latency(rows, latencies):
    data = [("sequential", v, None) for v in latencies] + [("sequential", 1e9, "e"), ("down", 1.0, "e")]
    got = {r.phase: r for r in requests.latency_stats(rows(data, LOG)).collect()}
    r = got["sequential"]
    assert [r.min_ms, r.max_ms, r.mean_ms, r.median_ms, r.p95_ms, r.p99_ms] == pytest.approx(expected(latencies), abs=0.051)
    assert (r.n_total, r.n_errors, r.n_ok) == (len(latencies) + 1, 1, len(latencies))
    assert (got["down"].n_ok, got["down"].p95_ms, got["down"].min_ms) == (0, None, None)


def test_index_percentile_is_not_the_discrete_one(rows):
    df = rows([("sequential", float(i), None) for i in range(1, 21)], LOG)
    assert requests.latency_stats(df).first().p95_ms == 20.0


def test_sla(rows, values):
    stats_rows = rows([("sequential", 4999.9), ("concurrent", 9e9)], "phase string, p95_ms double")
    assert values(requests.sla_gate(stats_rows), "passed") == [(True,)]
    assert values(requests.sla_gate(stats_rows, limit_ms=1.0), "passed") == [(False,)]
    assert values(requests.sla_gate(stats_rows.where("phase = 'x'")), "p95_ms", "passed") == [(None, False)]


def test_outcomes(rows, values):
    df = rows([(1, 200, "b", None, "max"), (2, 503, "y" * 200, None, None), (3, None, None, "z" * 200, None), (4, 200, "b", None, None)],
              "id int, status_code int, body string, exception string, urgency_level string")
    got = requests.classify_outcomes(df)
    assert values(got, "id", "status_code", "urgency_level", "error") == [
        (1, 200, "max", None), (2, 503, None, "HTTP 503: " + "y" * 120), (3, 0, None, "z" * 120), (4, 200, None, None),
    ]
    assert [tuple(r) for r in requests.level_counts(got).collect()] == [("max", 1), (None, 1)]
    assert values(requests.error_rate(got.withColumn("phase", F.lit("s")))) == [("s", 4, 2)]


def test_token_lengths_against_the_tokenizer(spark, rows, values):
    import public_tokenizers
    from tokenizers import Tokenizer

    from corpusloom.queries.jobs import token_counter

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [None, "", "Une phrase d'essai.", "<|endoftext|> x", "word " * 3000, "\n\n é 😀"]
    got = stats.with_token_length(
        rows(list(enumerate(texts)), "id int, text string"), F.col("text"), tokenizer_factory=token_counter(path))
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    assert values(got, "id", "n_tokens") == [
        (i, len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]


def test_token_lengths_in_bounded_calls(spark, values):
    """However many rows a batch has, the tokenizer sees little more than ``CALL_BYTES`` at once."""
    bound = stats.CALL_BYTES + 5000

    def factory():
        def count(texts):
            sent = sum(len((t or "").encode()) for t in texts)
            if sent > bound:
                raise ValueError(f"{sent} bytes at once")
            return [len(t or "") for t in texts]

        return count

    data = spark.range(0, 600, 1, 1).select(
        "id", F.when(F.col("id") % 7 != 0, F.repeat(F.lit("é"), (F.col("id") * 4).cast("int"))).alias("text"))
    got = stats.with_token_length(data, F.col("text"), tokenizer_factory=factory).select("id", "n_tokens")
    assert sorted(map(tuple, got.collect())) == [(i, i * 4 if i % 7 else 0) for i in range(600)]
    assert stats.with_token_length(data.limit(0), F.col("text"), tokenizer_factory=factory).count() == 0
