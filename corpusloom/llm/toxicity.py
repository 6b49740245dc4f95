"""Operator 10: toxicity by a linear classifier over character n-grams scaled by naive Bayes.

The words of a text are lower-cased and set between two ``_``; their character n-grams (2 to 6) are
hashed into a fixed number of columns.  A column counts twice: present or not, and as the logarithm
of its rate per word, so that one insult in a long text and a mild word used all over a short one
both show.  Either is scaled by its naive Bayes log-count ratio
``r_j = log (p_j / |p|) / (q_j / |q|)``, where ``p`` and ``q`` sum the feature over the toxic and the
other training texts; logistic regression with an L2 penalty is fitted on the scaled features.
Training uses at most ``MAX_ROWS`` labelled rows of at most ``MAX_CHARS`` code points each, chosen
by a hash of their id; scoring reads every whole text.

A null or empty text has no features and scores by the bias alone.  Rows with a null label are not
learnt from; of repeated labels of one document the highest counts.  Without labelled rows the
score is 0.5, with one class only that class.  Other columns pass through; one named like the result
gives way to it, and ``score`` takes another name for the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import held_out, returning, sampled, texts_of
from corpusloom.llm.words import distinct_words, in_runs

MAX_ROWS = 6_000
MAX_CHARS = 20_000
BITS = 20
ORDERS = (2, 3, 4, 5, 6)
# The n-grams with weights, chosen from all that occur; so many keep the fit within the driver's memory.
MAX_FEATURES = 5_000
MIN_TEXTS = 5
# Texts whose words are looked at together, in bytes; counts of texts by columns, and places of words, held at once.
SLICE = 2 << 20
CELLS = 500_000
PLACES = 100_000

_MASK = np.uint32((1 << BITS) - 1)


def _crc_table() -> np.ndarray:
    found = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        found = np.where(found & 1, (found >> 1) ^ np.uint32(0xEDB88320), found >> 1)
    return found


_CRC = _crc_table()


def _crc_step(crc: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """States of crc32 after one more byte."""
    return _CRC[(crc ^ byte) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))


def columns_of(words: list[str], number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of lower-cased words, one word after the other, and where those of each word begin.

    A column is crc32 of an n-gram's UTF-8, cut to ``BITS`` bits.  With ``number``, columns are numbered
    by it and those below 0 left out.
    """
    if not words:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    data = np.frombuffer("".join(["_", "_\n_".join(words), "_\n"]).encode(), np.uint8)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(at, len(data)))
    end = np.flatnonzero(data[at] == 10)
    owner = np.repeat(np.arange(len(words)), np.diff(np.concatenate(([-1], end))))
    left = end[owner] - np.arange(len(at))
    place, crc = np.arange(len(at)), np.full(len(at), 0xFFFFFFFF, np.uint32)
    width = 1 << BITS if number is None else int(number.max(initial=0)) + 1
    pairs = [np.zeros(0, np.int64)]
    for n in range(1, max(ORDERS) + 1):
        # The states after n characters, from every character with so many left.
        some = left[place] >= n
        place, crc = place[some], crc[some]
        last = place + (n - 1)
        crc = _crc_step(crc, data[at[last]])
        for byte in range(1, 4):
            wide = np.flatnonzero(size[last] > byte)
            crc[wide] = _crc_step(crc[wide], data[at[last[wide]] + byte])
        if n in ORDERS:
            column, mine = ((crc ^ np.uint32(0xFFFFFFFF)) & _MASK).astype(np.int64), owner[place]
            if number is not None:
                column = number[column].astype(np.int64)
                column, mine = column[column >= 0], mine[column >= 0]
            pairs.append(mine * width + column)
    found = np.sort(np.concatenate(pairs))
    found = found[np.diff(found, prepend=-1) > 0]
    return (found % width).astype(np.int32), np.searchsorted(found, np.arange(len(words) + 1) * width)


def _of_places(number: np.ndarray, columns: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The columns of the words at each place, and the place of each of them."""
    sizes = begin[number + 1] - begin[number]
    at = np.repeat(begin[number] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return columns[at], np.repeat(np.arange(len(number)), sizes)


def rates(counts: np.ndarray, words: int | np.ndarray) -> np.ndarray:
    """Logarithm of the count per fifty words; short texts count as a little longer."""
    return np.log1p(50 * counts / (words + 20))


class Model:
    """The chosen columns, their weights when present and by rate, and a bias."""

    def __init__(self, chosen: np.ndarray, present: np.ndarray, rate: np.ndarray, bias: float):
        self.chosen, self.present, self.rate, self.bias = chosen, present, rate, bias
        self.number = np.full(1 << BITS, -1, np.int32)
        self.number[chosen.astype(np.int64)] = np.arange(len(chosen))

    def counts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """In how many words of each text each of its chosen columns is: texts, columns, counts, and the texts' words."""
        words, number, bounds = distinct_words([text.lower() for text in texts])
        columns, begin = columns_of(words, self.number)
        width = max(1, len(self.chosen))
        lengths = np.diff(bounds)
        row = np.repeat(np.arange(len(texts)), lengths)
        step = max(1, CELLS // width)
        for first in range(0, len(texts), step):
            n = min(step, len(texts) - first)
            sums = np.zeros(n * width, np.int64)
            for at in range(bounds[first], bounds[first + n], PLACES):
                places = slice(at, min(at + PLACES, bounds[first + n]))
                column, place = _of_places(number[places], columns, begin)
                sums += np.bincount((row[places] - first)[place] * width + column, minlength=len(sums))
            found = np.flatnonzero(sums)
            text = found // width + first
            yield text, found % width, sums[found], lengths[text]

    def score(self, texts: list[str]) -> np.ndarray:
        margin = np.full(len(texts), float(self.bias))
        for text, column, counts, words in self.counts(texts):
            margin += np.bincount(text, self.present[column] + self.rate[column] * rates(counts, words), len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def fit(rows: Iterable[tuple[str, int]]) -> Model:
    """Train on (text, 0 or 1) pairs; small enough for one process by the bounds of the caller.

    The texts are read twice: for the sums of all columns, and for the features of the chosen ones.
    """
    rows = list(rows)
    y = np.array([label for _, label in rows], float)
    none = np.zeros(0)
    if not len(y) or y.min() == y.max():
        return Model(none, none, none, 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    size = 1 << BITS
    there, rate = np.zeros((2, size), np.float32), np.zeros((2, size), np.float32)
    texts = pa.array([text for text, _ in rows], pa.large_string())
    for some in in_runs(texts, SLICE // 2):
        words, number, bounds = distinct_words([rows[at][0].lower() for at in some])
        columns, begin = columns_of(words)
        for at, first, last in zip(some, bounds, bounds[1:]):
            found, counts = np.unique(_of_places(number[first:last], columns, begin)[0], return_counts=True)
            label = rows[at][1]
            there[label, found] += 1
            rate[label, found] += rates(counts, last - first)
    ratios = [_ratio(there), _ratio(rate)]
    seen = there.sum(axis=0)
    worth = np.where(seen >= MIN_TEXTS, np.abs(ratios).max(axis=0) * np.sqrt(seen), 0)
    chosen = np.sort(np.argsort(-worth, kind="stable")[:MAX_FEATURES])
    chosen = chosen[worth[chosen] > 0]
    model = Model(chosen, ratios[0][chosen], ratios[1][chosen], 0.0)
    parts = []
    for first in range(0, len(rows), 500):
        at, column, value = [np.zeros(0, np.int16)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        for some in in_runs(texts.slice(first, 500), SLICE // 2):
            for text, mine, counts, words in model.counts([rows[first + k][0] for k in some]):
                at.append(some[text].astype(np.int16))
                column.append(mine.astype(np.int32))
                value.append(rates(counts, words).astype(np.float32))
        parts.append(tuple(np.concatenate(one) for one in (at, column, value)))
    present, by_rate, bias = _logistic(parts, model.present, model.rate, y)
    return Model(chosen, present * model.present, by_rate * model.rate, bias)


def _ratio(sums: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of each column, smoothed by one."""
    other, toxic = sums + 1
    return np.log(toxic / toxic.sum()) - np.log(other / other.sum())


def _logistic(parts: list[tuple], present: np.ndarray, rate: np.ndarray, y: np.ndarray, steps: int = 150,
              speed: float = 0.05, penalty: float = 5e-3) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the two scaled features of each column, and the bias, by logistic regression.

    ``parts`` hold (row, column, rate) triples of 500 rows each; ``present`` and ``rate`` are the
    scales of a column that is present and of its rate.
    """
    size = len(present)
    w, b = np.zeros(2 * size), float(np.log(y.mean() / (1 - y.mean())))
    first, second = np.zeros(2 * size + 1), np.zeros(2 * size + 1)
    for step in range(1, steps + 1):
        slope = np.zeros(2 * size + 1)
        on, by = present * w[:size], rate * w[size:]
        for number, (at, column, value) in enumerate(parts):
            truth = y[500 * number : 500 * number + 500]
            margin = np.bincount(at, on[column] + value * by[column], len(truth)) + b
            miss = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - truth) / len(y)
            slope[:size] += present * np.bincount(column, miss[at], size)
            slope[size:-1] += rate * np.bincount(column, value * miss[at], size)
            slope[-1] += miss.sum()
        slope[:-1] += penalty * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        move = speed * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w[:size], w[size:], float(b)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on a bounded sample of the rows that are not held out."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    wanted = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # max_rows ids at most, so they may be broadcast; one text of each reaches the driver.
    sample = sampled(wanted, max_rows)
    texts = docs.select("doc_id", "text").where(F.length("text") <= max_chars)
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = rows.toPandas().sort_values("doc_id", kind="stable")
    return fit(zip(rows["text"], rows["toxic"].astype(int)))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` between 0 and 1; an input column of that name gives way to it."""
    docs = docs.drop(name)
    sent = docs.sparkSession.sparkContext.broadcast((model.chosen, model.present, model.rate, model.bias))
    schema = docs.select("*", F.lit(0.0).alias(name)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            texts = texts_of(batch)
            found = np.empty(len(texts))
            for rows in in_runs(texts, SLICE):
                found[rows] = model.score(texts.slice(rows[0], len(rows)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(returning(scored), schema)
