"""Operator 9: mixing to target weights by soft membership in domains.

A labelled table says for some documents which domain they belong to.  Softmax regression over
hashed words and a few measures of the text, fitted on a bounded sample of those, gives every
document its probabilities ``p_dk`` of the domains.  Nonnegative document rates ``r_d`` are then
fitted by projected gradient descent on

    1/2 sum_k (sum_d r_d n_d p_dk - T_k)^2 / M_k  +  mu/2 sum_d n_d (r_d - 1)^2

where ``n_d`` are the words of a document, ``T_k`` the target total of a domain and ``M_k`` its
total at rate one.  Measured by the words of each document, the gradient of a document depends on
its probabilities and on the residuals of the K domains only, and a step of 1 / (1 + mu) is safe.
So a step is one aggregation to K sums, and a rate is found from the probabilities and the short
list of all residuals so far; no rates are stored between steps.  The descent ends when all totals
are within a tolerance of the targets' sum, or when the gap no longer falls; then a warning gives it.

A document then appears ``floor(rate)`` times, and once more with the probability of the rest, by a
hash of its id and text.  The targets are shares; unless a total is given it is chosen such that
the domain with the largest target keeps its words, that is, most documents keep a rate of one.

A null or empty text has no words: its probabilities are those of the features it lacks and its
rate moves no total.  Documents without a label are not learnt from.  Targets without a labelled
document are dropped and the others rescaled; without any label or without targets every rate is
1.  Repeated rows are documents of their own with equal rates.  Other columns pass through ``mix``.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_IDS, bounded, fresh, held_out, returning, sampled, stored

MAX_ROWS = 4_000
MAX_CHARS = 20_000
BITS = 16
PENALTY = 1e-3
TOLERANCE = 1e-3
# The descent ends where so many steps lower the gap by less than a hundredth of the tolerance.
STALL = 20
#: Shares of the words of the mixture, by domain.
TARGETS = {"good": 0.90, "poor": 0.09, "toxic": 0.01}

_WORDS = re.compile(r"[^\W\d_]+")


def domain_of_labels():
    """Column of the domain in a table of quality and toxicity labels."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


def features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Columns and values of a text, and its number of words."""
    tokens = text.split()
    words = set(_WORDS.findall(text.lower()))
    columns = np.unique(np.fromiter((zlib.crc32(w.encode()) & ((1 << BITS) - 1) for w in words), np.int32, len(words)))
    letters = sum(map(len, words))
    lines = text.split("\n")
    dense = np.array([
        1.0, np.log1p(len(tokens)) / 10, letters / (len(words) + 1) / 10,
        len(re.findall(r"\d", text)) / (len(text) + 1) * 5,
        len(re.findall(r"[^\w\s.,]", text)) / (len(text) + 1) * 5, 1 - len(set(lines)) / len(lines),
        len(words) / (len(tokens) + 1),
    ])
    values = np.concatenate([np.full(len(columns), 1.0), dense])
    return np.concatenate([columns, (1 << BITS) + np.arange(len(dense), dtype=np.int32)]), values, len(tokens)


DENSE = 7


class Model:
    """Domains and the weights of their features."""

    def __init__(self, domains: list[str], weights: np.ndarray):
        self.domains, self.weights = domains, weights

    def probabilities(self, text: str) -> tuple[np.ndarray, int]:
        columns, values, words = features(text)
        margin = values @ self.weights[columns]
        share = np.exp(margin - margin.max())
        return share / share.sum(), words


def fit(rows: list[tuple[str, str]], steps: int = 120, speed: float = 0.05, penalty: float = 2e-4) -> Model:
    """Softmax regression on (text, domain) pairs; small enough for one process by the caller's bounds."""
    domains = sorted({domain for _, domain in rows})
    size, k = (1 << BITS) + DENSE, len(domains)
    weights = np.zeros((size, k))
    if k < 2:
        return Model(domains, weights)
    truth = np.zeros((len(rows), k))
    at, column, value = [], [], []
    for row, (text, domain) in enumerate(rows):
        columns, values, _ = features(text)
        truth[row, domains.index(domain)] = 1
        at.append(np.full(len(columns), row, np.int32))
        column.append(columns)
        value.append(values.astype(np.float32))
    at, column, value = np.concatenate(at), np.concatenate(column), np.concatenate(value)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        margin = np.stack([np.bincount(at, value * weights[column, j], len(rows)) for j in range(k)], axis=1)
        share = np.exp(margin - margin.max(axis=1, keepdims=True))
        miss = (share / share.sum(axis=1, keepdims=True) - truth) / len(rows)
        slope = np.stack([np.bincount(column, value * miss[at, j], size) for j in range(k)], axis=1) + penalty * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        weights -= speed * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(domains, weights)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out; ``labels`` has doc_id and domain."""
    usable = labels.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    wanted = usable.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    # max_rows ids at most, so they may be broadcast; one text of each reaches the driver.
    sample = sampled(wanted, max_rows)
    texts = docs.select("doc_id", "text").where(F.length("text") <= max_chars)
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    rows = rows.toPandas().sort_values("doc_id", kind="stable")
    return fit(list(zip(rows["text"], rows["domain"])))


def memberships(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, mark, n_tokens, p): words and probabilities of every row; the mark stands for the text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.domains, model.weights))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            found = [model.probabilities(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array([n for _, n in found], pa.int64()),
                 pa.array([p for p, _ in found], pa.list_(pa.float64()))],
                names=["doc_id", "mark", "n_tokens", "p"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(returning(predicted), "doc_id long, mark long, n_tokens long, p array<double>")


def rates_of(p: np.ndarray, residuals: list[np.ndarray], mu: float) -> np.ndarray:
    """Rates of rows of probabilities after one projected gradient step per vector of residuals."""
    rate = np.ones(len(p))
    for residual in residuals:
        rate = np.maximum(0.0, rate - (p @ residual + mu * (rate - 1)) / (1 + mu))
    return rate


def _sums(members: DataFrame, residuals: list[np.ndarray], k: int, mu: float) -> np.ndarray:
    """Expected words per domain at the rates of so many steps; every task sends one row of sums."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            p = batch.column("p").flatten().to_numpy().reshape(-1, k)
            total += (rates_of(p, residuals, mu) * batch.column("n_tokens").to_numpy()) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(total)], names=["k", "words"])

    rows = members.select("n_tokens", "p").mapInArrow(summed, "k int, words double")
    found = {row["k"]: row["words"] for row in rows.groupBy("k").agg(F.sum("words").alias("words")).collect()}
    return np.array([found.get(at, 0.0) for at in range(k)])


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], total: float | None = None,
              mu: float = PENALTY, steps: int | None = None, tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """The residuals of the descent, from which ``rates_of`` finds any document's rate.

    ``steps`` ends the descent early.  A gap beyond the tolerance is told by a warning.
    """
    k = len(domains)
    share = np.array([max(0.0, targets.get(domain, 0.0)) for domain in domains])
    if k < 2 or not share.sum():
        return []
    share /= share.sum()
    plain = _sums(members, [], k, mu)
    if not (plain * share).sum():
        return []
    if total is None:
        largest = max(range(k), key=lambda at: (share[at] if plain[at] > 0 else 0.0, -at))
        total = plain[largest] / share[largest]
    goal, scale = share * total, np.maximum(plain, 1e-9)
    residuals: list[np.ndarray] = []
    sums = plain
    gaps = [np.abs(sums - goal).max() / goal.sum()]
    while gaps[-1] > tolerance and (steps is None or len(residuals) < steps):
        if len(gaps) > STALL and min(gaps[:-STALL]) - min(gaps[-STALL:]) < tolerance / 100:
            break
        residuals.append((sums - goal) / scale)
        sums = _sums(members, residuals, k, mu)
        gaps.append(np.abs(sums - goal).max() / goal.sum())
    if gaps[-1] > tolerance:
        warnings.warn(f"the mix misses its targets by {gaps[-1]:.2%} of all words after {len(residuals)} steps", stacklevel=2)
    return residuals


def with_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
               total: float | None = None) -> DataFrame:
    """Stored (doc_id, mark, n_tokens, domain, probability, rate, copies) of every row of ``docs``."""
    model = train(docs, labels)
    targets = TARGETS if targets is None else targets
    k = max(1, len(model.domains))
    if not model.domains:
        model = Model([""], np.zeros(((1 << BITS) + DENSE, 1)))
    members = stored(memberships(docs, model), "members")
    residuals = fit_rates(members, model.domains, targets, total)
    names = model.domains

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column("p").flatten().to_numpy().reshape(-1, k)
            rate = np.round(rates_of(p, residuals, PENALTY), 9)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), batch.column("n_tokens"),
                 pa.array([names[at] for at in p.argmax(axis=1)], pa.string()), pa.array(p.max(axis=1)), pa.array(rate)],
                names=["doc_id", "mark", "n_tokens", "domain", "probability", "rate"],
            )

    schema = "doc_id long, mark long, n_tokens long, domain string, probability double, rate double"
    rows = members.mapInArrow(rated, schema)
    chance = F.pmod(F.xxhash64("doc_id", "mark", F.lit("copies")), F.lit(1_000_000)) / 1_000_000
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return rows.withColumn("copies", copies.cast("int"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, total: float | None = None) -> DataFrame:
    """Each row of ``docs`` as often as its rate says; other columns pass through, whatever their names."""
    rated = stored(with_rates(docs, labels, targets, total).select("doc_id", "mark", "copies").distinct(), "copies")
    changed = rated.where("copies != 1").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "copies")
    if bounded(changed, BROADCAST_IDS):
        changed = F.broadcast(changed)
    same = docs["doc_id"].eqNullSafe(changed["_id"]) & (F.xxhash64(docs["text"]) == changed["_mark"])
    copies, each = F.coalesce(changed["copies"], F.lit(1)), fresh("_copy", docs)
    joined = docs.join(changed, same, "left").where(copies > 0)
    repeated = F.explode(F.array_repeat(F.lit(0), copies)).alias(each)
    return joined.select(*[docs[c] for c in docs.columns], repeated).drop(each)
