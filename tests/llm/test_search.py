"""Operator 11 against a plain ranking of all documents."""

import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import signatures

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(docs, items, hits=10):
    terms = [(number, split(text)) for number, text in docs]
    terms = [(number, words) for number, words in terms if words]
    n_docs, total = len(terms), sum(len(words) for _, words in terms)
    held = Counter(word for _, words in terms for word in set(words))
    rows = []
    for item, text in dict.fromkeys(items):
        scores = []
        for number, words in terms:
            m, counts = 25 + (75 * len(words) * n_docs) // total, Counter(words)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[word] + 1)))
                        * ((1000000000 * counts[word]) // (1000 * counts[word] + 8 * m)) for word in split(text) if counts[word])
            if score > 0:
                scores.append((-score, number is not None, number))
        rows += [(item, rank, number, -score) for rank, (score, _, number) in enumerate(sorted(scores)[:hits], 1)]
    return sorted(rows, key=repr)


def tables(spark, pairs, items):
    docs = spark.createDataFrame([(*p, 1, "x") for p in pairs], "doc_id long, text string, item_id int, mark string")
    asked = spark.createDataFrame([(*p, 2, "y") for p in items], "item_id long, text string, doc_id int, mark string")
    return docs.repartition(5), asked


@pytest.fixture
def corpus():
    random.seed(7)
    words = [f"w{k}" for k in range(300)] + ["Über", "NAÏVE", "x", "9"]
    odds = [1 / (k + 1) for k in range(len(words))]
    text = lambda n: random.choice([" ", "-", "_"]).join(random.choices(words, odds, k=n))
    pairs = [(k, text(random.choice([1, 3, 20, 200, 900]))) for k in range(260)]
    pairs += [(1000, None), (1001, ""), (1002, "!!! ..."), (None, text(30)), (5, pairs[5][1]), (6, text(40)), (2000, "w7 " * 5000)]
    items = [(k, text(random.choice([1, 5, 25]))) for k in range(30)]
    items += [(50, None), (51, ""), (52, "unseen words only"), (3, items[3][1]), (4, text(6)), (None, text(8)), (53, "w1 w1 w1")]
    return pairs, items


@pytest.mark.parametrize("item_terms", [signatures.ITEM_TERMS, 40])
def test_search_against_plain(spark, corpus, item_terms):
    docs, items = tables(spark, *corpus)
    got = signatures.search(signatures.build_index(docs), docs, items, item_terms=item_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(*corpus)


def test_dense_filters_and_small_blocks(spark, corpus, monkeypatch):
    """Bounds far too high, blocks of few documents and few hits change nothing."""
    monkeypatch.setattr(signatures, "BITS_PER_ENTRY", 1)
    monkeypatch.setattr(signatures, "BLOCK_DOCS", 9)
    monkeypatch.setattr(signatures, "COUNTED", 50)
    monkeypatch.setattr(signatures, "BROADCAST_IDS", 3)
    docs, items = tables(spark, *corpus)
    got = signatures.search(signatures.build_index(docs), docs, items, hits=3)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_search(*corpus, hits=3)


def test_bounds_are_never_below_scores(spark, corpus):
    pairs, items = corpus
    docs, asked = tables(spark, pairs, items)
    index = signatures.build_index(docs)
    n_docs, n_terms = index.totals()
    rows = signatures._item_terms(asked).join(index.terms(), "term").collect()
    questions = signatures.Questions(rows, n_docs, n_terms)
    texts, close = dict(pairs), 0
    every = list(range(len(questions.items)))
    for block in index.blocks().collect():
        bounds = questions.bounds(block["matrix_rows"], bytes(block["bits"]), np.array(block["lengths"]))
        for column, number in enumerate(block["ids"]):
            if number in (5, 6):
                continue  # two rows
            exact = questions.scores(texts[number], every)
            assert all(bounds[:, column] >= exact)
            close += sum(bounds[:, column] <= [1.2 * x for x in exact])
    assert close > 0.8 * n_docs * len(every)  # and mostly near them


def test_empty_tables(spark, corpus):
    docs, items = tables(spark, *corpus)
    none = signatures.build_index(docs.limit(0))
    assert none.totals() == (0, 0)
    assert signatures.search(none, docs.limit(0), items).count() == 0
    assert signatures.search(signatures.build_index(docs), docs, items.limit(0)).count() == 0
