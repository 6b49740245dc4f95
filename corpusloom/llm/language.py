"""Operator 4: language of texts by a linear-chain conditional random field over their words.

Every word is labelled with a language.  Its features are its prefixes and suffixes up to four
letters, its letter pairs and triples, and the word itself if the training lexicon has it; each
feature has a learned weight per language, and each pair of neighbouring labels a learned
transition, so a word that several languages share takes the language of its surroundings and
code-switched text is cut where it switches.  Forward-backward gives the probability of each label
at each word; the mean over the words of a text is the text's distribution over languages.  The
features of a slice's distinct words are hashed and looked up side by side, each word once a slice.

Training takes at most ``MAX_ROWS`` texts of each language, of at most ``MAX_CHARS`` code points
each, chosen by a hash of their id.  Runs of their words are strung together, two or three texts
to a sequence, so that transitions are learnt from switches as well.  Of the features that occur
twice at least, the ``MAX_FEATURES`` most frequent have weights.

The prediction is ``und`` with score 0 if the text is null or has no letter, or if nothing could be
learnt.  Rows with a null language are not learnt from; of rows with equal id and language the
first text is.  Ties go to the first language by name.  Other columns pass through, but for those
named like the two results, which give way to them; ``predict`` takes other names for the results.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import held_out, returning, sampled
from corpusloom.llm.hashing import mix, place_factors
from corpusloom.llm.words import WORDS, code_points, distinct_words, in_runs

MAX_ROWS = 400
MAX_CHARS = 20_000
MAX_FEATURES = 60_000
# Texts whose words are looked at together, in bytes, and the numbers that go through the recursion together.
SLICE = 2 << 20
CELLS = 1_000_000
# Words whose features are hashed side by side; a feature takes some 50 bytes until it is weighed.
WORDS_AT_ONCE = 1 << 14
SLOT_BITS = 20
UNKNOWN = "und"

_SLOT = np.uint64(64 - SLOT_BITS)
_FACTOR = np.uint64(0x9FB21C651E98DF25)
# Whole words, prefixes, suffixes and letter n-grams: a number for each, so that equal letters differ by kind.
_KINDS = {kind: np.uint64(0x9E3779B97F4A7C15 * at % (1 << 64)) for at, kind in enumerate(("=", "^", "$", ""), 1)}


def features(word: str) -> list[str]:
    """Names of the features of a word: affixes, letter n-grams, the word."""
    word = word.lower()
    found = ["=" + word]
    for n in range(1, min(4, len(word)) + 1):
        found += ["^" + word[:n], "$" + word[-n:]]
    for n in (2, 3):
        found += [word[at : at + n] for at in range(len(word) - n + 1)]
    return found


class Index:
    """The numbers of known features, found by hashes of 64 bits for all features of many words at once."""

    def __init__(self, names: dict[str, int]):
        hashes, number = [], []
        by_kind: dict[str, list[str]] = {kind: [] for kind in _KINDS}
        for name in names:
            kind = name[0] if name[0] in _KINDS and len(name) > 1 else ""
            by_kind[kind].append(name[len(kind) :])
        for kind, rest in by_kind.items():
            if rest:
                codes, begin, end = _lines(rest)
                if kind == "=":
                    found = _whole(codes, begin)
                else:
                    grams, size = _grams(codes), end - begin
                    found = np.choose(size - 1, [gram[begin] for gram in grams])
                hashes.append(mix(found + _KINDS[kind]))
                number.append(np.array([names[kind + one] for one in rest], np.int32))
        self.keys = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.number = np.concatenate([*number, np.zeros(0, np.int32)])[order]
        # The keys of one slot lie side by side; most slots have none or one.
        slots = (self.keys >> _SLOT).astype(np.int64)
        self.first = np.searchsorted(slots, np.arange((1 << SLOT_BITS) + 1)).astype(np.int32)
        self.most = int(np.diff(self.first).max())

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known hashes, and their numbers."""
        slot = (hashes >> _SLOT).astype(np.int64)
        at, stop = self.first[slot], self.first[slot + 1]
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        left = np.flatnonzero(at < stop)
        for step in range(self.most):
            left = left[at[left] + step < stop[left]]
            same = self.keys[at[left] + step] == hashes[left]
            places.append(left[same])
            numbers.append(self.number[at[left[same]] + step])
        return np.concatenate(places), np.concatenate(numbers)

    def features(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the word, number of the feature) of all known features, as ``features`` names them."""
        # Lower case turns on the letters beside it, so a line end stands for the end of a word.
        codes, begin, end = _lines(words)
        every = np.arange(len(begin))
        grams, size = _grams(codes), end - begin
        found = [(_whole(codes, begin) + _KINDS["="], every)]
        for n, gram in enumerate(grams, 1):
            some = every[size >= n]
            found.append((gram[begin[some]] + _KINDS["^"], some))
            found.append((gram[end[some] - n] + _KINDS["$"], some))
        owner = np.repeat(every, size + 1)
        for n in (2, 3):
            at = np.flatnonzero(np.arange(len(codes)) + n <= end[owner])
            found.append((grams[n - 1][at] + _KINDS[""], owner[at]))
        while found:
            hashes, owner = found.pop()
            places, numbers = self.find(mix(hashes))
            yield owner[places], numbers


def _lines(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased words, a line end behind each, and where the words begin and end."""
    codes = code_points(("\n".join(words) + "\n").lower())
    end = np.flatnonzero(codes == 10)
    return codes, np.concatenate(([0], end[:-1] + 1)), end


def _grams(codes: np.ndarray) -> list[np.ndarray]:
    """From each place, the hashes of the next 1, 2, 3 and 4 code points."""
    size = len(codes)
    codes = np.concatenate((codes, np.zeros(3, np.uint32))).astype(np.uint64)
    found = [codes[:size]]
    for n in range(1, 4):
        found.append(found[-1] * _FACTOR + codes[n : n + size])
    return found


def _whole(codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hash of each line, from its first code point to its end."""
    place = np.arange(len(codes)) - np.repeat(begin, np.diff(np.append(begin, len(codes))))
    return np.add.reduceat(codes.astype(np.uint64) * place_factors(int(place.max()) + 1)[place], begin)


class Model:
    """Weights of a trained field."""

    def __init__(self, languages: list[str], names: dict[str, int], weights: np.ndarray, switch: np.ndarray):
        self.languages, self.names, self.weights, self.switch = languages, names, weights, switch
        self.index = Index(names)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Exponentiated weights of each language (a row) at each word (a column)."""
        table = np.zeros((len(self.languages), len(words)))
        for first in range(0, len(words), WORDS_AT_ONCE):
            part = table[:, first : first + WORDS_AT_ONCE]
            for owner, number in self.index.features(words[first : first + WORDS_AT_ONCE]):
                for language, weights in enumerate(self.weights.T):
                    part[language] += np.bincount(owner, weights[number], part.shape[1])
        table -= table.max(axis=0)
        return np.exp(table, out=table)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        texts = [text if text and any(map(str.isalpha, text)) else "" for text in texts]
        words, number, bounds = distinct_words(texts)
        if not self.languages or not words:
            return names, scores
        table, switch = self.emissions(words), np.exp(self.switch - self.switch.max())
        for group, marginals in _side_by_side(table, number, bounds, switch):
            lengths = np.diff(bounds)[group]
            share = np.add.reduceat(marginals, np.cumsum(lengths) - lengths, axis=1) / lengths
            for at, best, score in zip(group, share.argmax(axis=0), share.max(axis=0)):
                names[at], scores[at] = self.languages[best], float(min(1.0, score))
        return names, scores


def forward_backward(sequences: list[np.ndarray], switch: np.ndarray) -> list[np.ndarray]:
    """Label probabilities at every word of every sequence.

    ``sequences`` hold exponentiated word weights, ``switch`` exponentiated transitions.
    """
    found: list = [np.zeros((0, len(switch)))] * len(sequences)
    bounds = np.cumsum([0, *map(len, sequences)])
    table = np.concatenate([*sequences, np.zeros((0, len(switch)))]).T
    for group, marginals in _side_by_side(table, np.arange(bounds[-1]), bounds, switch):
        for at, one in zip(group, np.split(marginals.T, np.cumsum(np.diff(bounds)[group])[:-1])):
            found[at] = one
    return found


def _side_by_side(
    table: np.ndarray, number: np.ndarray, bounds: np.ndarray, switch: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of sequences that are not empty, with the label probabilities at their words, one sequence after the other.

    The word at each place is a column of ``table``; ``bounds`` tell where the sequences begin.  Those
    of similar length go through the recursion together, one word of each per step, without those
    that have ended.  The numbers of a group are bounded, so memory is too, but for a single longer text.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    run = np.cumsum(lengths[order]) * len(switch) // CELLS
    for group in np.split(order, np.flatnonzero(run[1:] != run[:-1]) + 1) if len(order) else ():
        size = lengths[group]
        # The words of one step lie together: how many sequences reach it, and where it begins.
        alive = len(group) - np.cumsum(np.bincount(size))[:-1]
        steps = np.concatenate(([0], np.cumsum(alive)))
        step = np.arange(steps[-1]) - np.repeat(np.cumsum(size) - size, size)
        cell = steps[step] + np.repeat(np.arange(len(group)), size)
        laid = np.empty(len(cell), np.int64)
        laid[cell] = number[step + np.repeat(bounds[group], size)]
        emit = table[:, laid]
        del step, laid
        forward = np.empty_like(emit)
        state = None
        for at, n in zip(steps.tolist(), alive.tolist()):
            here = emit[:, at : at + n]
            state = here / len(switch) if state is None else (switch.T @ state[:, :n]) * here
            state /= state.sum(axis=0)
            forward[:, at : at + n] = state
        state = None
        for at, n in zip(steps[-2::-1].tolist(), alive[::-1].tolist()):
            # Behind the end of a sequence the backward message stays even.
            if state is not None:
                m = state.shape[1]
                state = switch @ (state * emit[:, at + n : at + n + m])
                state /= state.sum(axis=0)
                forward[:, at : at + m] *= state
            if state is None or m < n:
                even = np.ones((len(switch), n))
                if state is not None:
                    even[:, :m] = state
                state = even
        forward /= forward.sum(axis=0)
        yield group, forward[:, cell]


def _sequences(rows: list[tuple[str, int]], random: np.random.Generator) -> list[tuple[list[str], list[int]]]:
    """Runs of 4 to 20 words, two or three texts to a sequence, covering the sampled texts."""
    runs = []
    for text, label in rows:
        words = WORDS.findall(text)
        at = 0
        while at < len(words):
            n = int(random.integers(4, 21))
            runs.append((words[at : at + n], label))
            at += n
    order = random.permutation(len(runs))
    made, at = [], 0
    while at < len(order):
        n = int(random.integers(2, 4))
        picked = [runs[k] for k in order[at : at + n]]
        made.append(([w for words, _ in picked for w in words], [y for words, y in picked for _ in words]))
        at += n
    return made


def fit(rows: list[tuple[str, str]], epochs: int = 3, rate: float = 0.2) -> Model:
    """Train on (text, language) pairs by AdaGrad on the conditional log-likelihood."""
    languages = sorted({language for _, language in rows})
    if not languages:
        return Model([], {}, np.zeros((0, 0)), np.zeros((0, 0)))
    label = {language: at for at, language in enumerate(languages)}
    random = np.random.default_rng(7)
    sequences = _sequences([(text, label[language]) for text, language in rows], random)
    words = Counter(word for sequence, _ in sequences for word in sequence)
    seen: Counter = Counter()
    for word, n in words.items():
        for name in set(features(word)):
            seen[name] += n
    # The lexicon and the n-grams are what occurs twice at least, the most frequent first.
    often = sorted((-n, name) for name, n in seen.items() if n > 1)[:MAX_FEATURES]
    del seen
    names = {name: at for at, (_, name) in enumerate(often)}
    number = {word: at for at, word in enumerate(words)}
    # Features are named again here rather than kept, as names take far more of the driver than numbers.
    flat, start = array("q"), [0]
    for word in words:
        flat.extend(names[n] for n in features(word) if n in names)
        start.append(len(flat))
    column, start = np.array(flat, np.int64), np.array(start)
    owner = np.repeat(np.arange(len(words)), np.diff(start))
    k = len(languages)
    weights, switch = np.zeros((len(names), k)), np.zeros((k, k))
    squares, switch_squares = np.full((len(names), k), 1e-6), np.full((k, k), 1e-6)
    coded = [(np.array([number[w] for w in ws]), np.array(ys)) for ws, ys in sequences]
    del sequences, words, number
    batch = 400
    for _ in range(epochs):
        order = random.permutation(len(coded))
        for first in range(0, len(order), batch):
            part = [coded[at] for at in order[first : first + batch]]
            used = np.unique(np.concatenate([ws for ws, _ in part]))
            rows_of = np.concatenate([np.arange(start[w], start[w + 1]) for w in used]).astype(np.int64)
            at_word = np.searchsorted(used, owner[rows_of])
            scores = np.zeros((len(used), k))
            np.add.at(scores, at_word, weights[column[rows_of]])
            slope, turns = _slopes(part, used, scores, switch)
            part_weights = np.zeros_like(weights)
            np.add.at(part_weights, column[rows_of], slope[at_word])
            n = sum(len(ws) for ws, _ in part)
            step = part_weights / n + 1e-6 * weights
            squares += step * step
            weights -= rate * step / np.sqrt(squares)
            step = turns / n
            switch_squares += step * step
            switch -= rate * step / np.sqrt(switch_squares)
    return Model(languages, names, weights, switch)


def _slopes(part, used: np.ndarray, scores: np.ndarray, switch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the negative log-likelihood: per word of ``used``, and of the transitions."""
    k = switch.shape[0]
    lengths = np.array([len(ws) for ws, _ in part])
    longest, n = lengths.max(), len(part)
    at = np.zeros((longest, n), np.int64)
    true = np.full((longest, n), -1)
    for column, (ws, ys) in enumerate(part):
        at[: len(ws), column] = np.searchsorted(used, ws)
        true[: len(ws), column] = ys
    there = true >= 0
    emit = np.where(there[:, :, None], np.exp(scores - scores.max(axis=1, keepdims=True))[at], 1.0)
    move = np.exp(switch - switch.max())
    forward, back = np.empty_like(emit), np.ones_like(emit)
    state = np.full((n, k), 1.0 / k)
    for step in range(longest):
        state = (state @ move if step else state) * emit[step]
        state /= state.sum(axis=1, keepdims=True)
        forward[step] = state
    for step in range(longest - 2, -1, -1):
        state = np.where(there[step + 1][:, None], (back[step + 1] * emit[step + 1]) @ move.T, 1.0)
        back[step] = state / state.sum(axis=1, keepdims=True)
    marginal = forward * back
    marginal /= marginal.sum(axis=2, keepdims=True)
    wrong = marginal - (true[:, :, None] == np.arange(k))
    slope = np.zeros_like(scores)
    np.add.at(slope, at[there], wrong[there])
    turns = np.zeros((k, k))
    for step in range(1, longest):
        pair = forward[step - 1][:, :, None] * move * (emit[step] * back[step])[:, None, :]
        pair = pair[there[step]]
        if not len(pair):
            break
        turns += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        np.add.at(turns, (true[step - 1][there[step]], true[step][there[step]]), -1.0)
    return slope, turns


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on a bounded sample of the rows that are not held out."""
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
        & (F.length("text") <= max_chars) & F.col("text").rlike(r"\p{L}")
    )
    # max_rows ids of each language at most, so they may be broadcast; one text of each reaches the driver.
    sample = sampled(usable.select("doc_id", "lang"), max_rows, "lang")
    keys = ["doc_id", "lang"]
    rows = usable.select(*keys, "text").join(F.broadcast(sample), keys).groupBy(*keys).agg(F.min("text").alias("text"))
    rows = rows.toPandas().sort_values(keys, kind="stable")
    return fit(list(zip(rows["text"], rows["lang"])))


def predict(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its score in columns ``names``; input columns so named give way to them."""
    docs = docs.drop(*names)
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.names, model.weights, model.switch))
    schema = docs.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1])).schema

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            texts = batch.column("text")
            languages, scores = np.empty(len(texts), object), np.empty(len(texts))
            for rows in in_runs(texts, SLICE, longest_first=True):
                languages[rows], scores[rows] = model.predict(texts.take(pa.array(rows)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, *names],
            )

    return docs.mapInArrow(returning(predicted), schema)


def word_languages(text: str, model: Model) -> list[tuple[str, str, float]]:
    """The words of a code-switched text with their languages and probabilities."""
    words = WORDS.findall(text)
    if not words or not model.languages:
        return []
    marginals = forward_backward([model.emissions(words).T], np.exp(model.switch - model.switch.max()))[0]
    return [(w, model.languages[int(m.argmax())], float(m.max())) for w, m in zip(words, marginals)]
