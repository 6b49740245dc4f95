"""Names by table: found as a plain search finds them, merged with other spans, masked."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.pii import EMAIL, PATTERN_RECOGNIZERS
from corpusloom.operators import name_table, pii

NAMES = ["Jean Dupont", "JEAN  dupont", "Ana-María O'Neil", "Li", "Dr. K. de la Cruz", "Łukasz", "", None, "...", "Ng Ân"]


def plain_hits(text, names):
    """Every run of words tested against every name."""
    listed = {tuple(w.lower() for w in re.findall(r"[^\W_]+", name or "")) for name in names} - {()}
    words = list(re.finditer(r"[^\W_]+", text or ""))
    found = []
    for first in range(len(words)):
        for last in range(first, min(first + 6, len(words))):
            if last > first and not re.fullmatch(r"[ \-'’.]{1,2}", text[words[last - 1].end() : words[last].start()]):
                break
            if tuple(w.group().lower() for w in words[first : last + 1]) in listed:
                found.append((words[first].start(), words[last].end()))
    return found


def test_against_plain_search(spark, rows):
    random.seed(4)
    words = ["Jean", "DUPONT", "Li", "Ana", "María", "O", "Neil", "x", "Dr", "K", "de", "la", "Cruz", "łukasz", "Ng", "ân"]
    texts = ["".join(w + random.choice([" ", "-", ". ", "'", ", ", "\n", "  "]) for w in random.choices(words, k=30)) for _ in range(60)]
    texts += [None, "", "Li", "Lily", "xLi", "Li2", "Jean\tDupont", "Dr. K. de la Cruz!", texts[0], "Li " * 3000]
    table = rows([(k, t, "x", 1) for k, t in enumerate(texts)], "id long, text string, hash string, words int")
    got = name_table.find_names(table.repartition(6), rows([(n, 1) for n in NAMES], "name string, id int"))
    want = [(k, "PERSON", a, b, 0.85, texts[k][a:b]) for k, t in enumerate(texts) for a, b in plain_hits(t, NAMES)]
    assert got.columns == ["id", "type", "start", "end", "score", "text"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 3000


def test_empty_tables(spark, rows):
    texts, names = rows([(1, "Jean Dupont")], "id long, text string"), rows([("Jean Dupont",)], "name string")
    assert name_table.find_names(texts, names.limit(0)).count() == 0
    assert name_table.find_names(texts.limit(0), names).count() == 0
    assert name_table.find_names(texts, names).count() == 1


def test_many_names_by_equality_only(spark):
    """A table of 100 000 names: joined by key, neither a nested loop nor a literal in the plan."""
    names = spark.range(100_000).select(F.concat(F.lit("first"), "id", F.lit(" last"), F.col("id") % 1000).alias("name"))
    texts = spark.range(2_000).select("id", F.concat(F.lit("It was First"), F.col("id") * 7, F.lit(" LAST"), F.col("id") * 7 % 1000, F.lit(".")).alias("text"))
    found = name_table.find_names(texts, names)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "first17" not in plan.lower()
    assert found.count() == 2_000


def test_names_are_made_once(spark):
    """The table of names is read once, however costly it is."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    names = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("name")).mapInArrow(counted, "name string")
    texts = spark.range(50).select("id", F.concat(F.lit("x N"), "id", F.lit(" y")).alias("text"))
    assert name_table.find_names(texts, names).count() == 50
    assert seen.value == 1000


def test_walker_forgets_and_goes_on(monkeypatch):
    """Runs across texts, unknown gaps and a small memory: as a filter that holds everything lets them through."""
    monkeypatch.setattr(name_table, "REMEMBERED", 2)
    walker = name_table.Walker(np.full(16, -1, np.int64).view(np.uint64), [1, 3])
    texts = ["Ab c-D", None, "", "...", "e. F g, h", "ab"]
    want = [(0, 0, 2, "ab"), (0, 3, 4, "c"), (0, 5, 6, "d"), (4, 0, 1, "e"), (4, 3, 4, "f"), (4, 5, 6, "g"),
            (4, 8, 9, "h"), (5, 0, 2, "ab"), (0, 0, 6, "ab c d"), (4, 0, 6, "e f g")]
    assert list(walker.hits(texts)) == [(r, a, b, name_table.run_hash(w.split()), w) for r, a, b, w in want]
    assert list(walker.hits([])) == list(walker.hits([None, ""])) == []


def test_filter_keeps_all_names_and_few_others(spark):
    hashed = spark.range(5_000).select(F.xxhash64("id").alias("hash"))
    bloom = name_table._filter_of(hashed, 5_000)
    own = np.array([row[0] for row in hashed.collect()], np.int64)
    others = np.array([row[0] for row in spark.range(50_000, 70_000).select(F.xxhash64("id")).collect()], np.int64)
    assert name_table._held(bloom, own).all()
    assert name_table._held(bloom, others).mean() < 0.05


@pytest.mark.parametrize("recognizers", [PATTERN_RECOGNIZERS, (EMAIL,)])
def test_masking(spark, rows, recognizers):
    table = rows([
        (1, "Jean Dupont wrote to jean.dupont@mail.org about Li.", "Li", "en"),
        (2, "Nobody here.", None, "en"), (3, None, "To Ng Ân-Li", "fr"), (4, "a@b.org", "Lily", "fr"),
    ], "id long, a string, b string, language string")
    names = rows([(n,) for n in NAMES], "name string")
    got = pii.anonymize(table, ["a", "b"], recognizers=recognizers, names=names, types=["PERSON", "EMAIL_ADDRESS"])
    assert sorted((r["id"], r["a"], r["b"]) for r in got.collect()) == [
        (1, "<PERSON> wrote to <EMAIL_ADDRESS> about <PERSON>.", "<PERSON>"), (2, "Nobody here.", None),
        (3, None, "To <PERSON>-<PERSON>"), (4, "<EMAIL_ADDRESS>", "Lily"),
    ]
    assert got.columns == ["id", "a", "b", "language", "entities"]
    spared = pii.anonymize(table, ["b"], recognizers=recognizers, names=names, allowlist=["li"])
    assert sorted((r["id"], r["b"]) for r in spared.collect())[2] == (3, "To <PERSON>-Li")
    with pytest.raises(ValueError):
        pii.anonymize(table, ["a"], recognizers=recognizers, types=["PERSON"])
