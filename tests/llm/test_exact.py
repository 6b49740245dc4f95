"""Operators with one right answer, against plain versions: 1, 2, 5, 6, 8."""

import collections
import hashlib
import random
import re
import string
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import decontaminate, lines, ngram_join, tokens, vectors
from corpusloom.llm.common import new_folder
from corpusloom.llm.queries import QUERIES, default_tokenizer
from corpusloom.llm.sql import SQL

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    answer = con.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    assert rows_of(QUERIES[name](spark, small), *columns) == sorted(answer.fetchall(), key=repr)


# ---- 1


def plain_overlaps(docs, items, window=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = collections.defaultdict(set)
    for item, text in items:
        words = split(text)
        n = min(window, len(words))
        for at in range(len(words) - n + 1) if n else ():
            grams[tuple(words[at : at + n])].add(item)
    found = []
    for number, text in docs:
        words, hit, ids = split(text), set(), set()
        for n in {len(g) for g in grams}:
            for at in range(len(words) - n + 1):
                if tuple(words[at : at + n]) in grams:
                    hit |= set(range(at, at + n))
                    ids |= {str(i) for i in grams[tuple(words[at : at + n])] if i is not None}
        found.append((number, len(words), len(hit), len(ids), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(found, key=repr)


def test_overlaps_against_plain(spark, docs):
    random.seed(3)
    words = ["Über", "a", "b", "C", "d9", "é", "x"]
    text = lambda n: " ".join(random.choices(words, k=n))
    items = [(k, text(random.choice([0, 1, 2, 5, 13, 14, 20]))) for k in range(12)] + [(3, text(15)), (None, text(16)), (7, None)]
    pairs = [(k, text(random.choice([0, 1, 3, 30, 80])) + random.choice(["", " ", "!? "])) for k in range(40)]
    pairs += [(100 + k, text(5) + "\n" + (t or "").upper() + ". " + text(9)) for k, (_, t) in enumerate(items)]
    pairs += [(200, None), (201, ""), (None, items[6][1]), (202, pairs[50][1]), (202, pairs[50][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    want = plain_overlaps(pairs, items)
    assert rows_of(decontaminate.overlaps(docs(pairs), bench), *columns) == want
    found, _ = decontaminate.hits(docs(pairs), bench, broadcast_windows=7)  # many blocks
    whole, _ = decontaminate.hits(docs(pairs), bench)
    assert rows_of(found.distinct(), *found.columns) == rows_of(whole.distinct(), *whole.columns)


def test_decontaminate_removes(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")],
                                  "item_id long, text string")
    quoted = "Before, ONE two  three four five six seven eight nine ten eleven twelve thirteen; after it."
    table = docs([(1, quoted), (2, "clean text"), (3, None), (4, "")])
    assert rows_of(decontaminate.decontaminate(table, bench), "doc_id") == [(2,), (3,), (4,)]
    cut = dict(rows_of(decontaminate.decontaminate(table, bench, "spans"), "doc_id", "text"))
    assert cut == {1: "Before; after it.", 2: "clean text", 3: None, 4: ""}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(table, nothing).count() == 4
    assert decontaminate.overlaps(table.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(table, bench).columns == table.columns


# ---- 2


def plain_vectors(rows, threshold=0.95):
    unit, alone = {}, []
    for at, (number, v) in enumerate(rows):
        if number is None or not v or None in v or not np.isfinite(v).all() or not any(v):
            alone.append(at)
        else:
            x = np.array(v, float) / np.abs(v).max()
            unit[at] = x / np.linalg.norm(x)
    near = {a: [b for b in unit if b != a and len(unit[b]) == len(unit[a]) and unit[a] @ unit[b] >= threshold] for a in unit}
    found = []
    for at, (number, _) in enumerate(rows):
        seen, waiting = {at}, [at]
        while waiting:
            for b in near.get(waiting.pop(), []):
                if b not in seen:
                    seen.add(b)
                    waiting.append(b)
        head = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        found.append((number, len(near.get(at, [])), head, number is None or head == number))
    return sorted(found, key=repr)


def test_vectors_against_plain(spark, monkeypatch):
    random_ = np.random.default_rng(5)
    rows = []
    for group in range(12):
        centre = random_.normal(size=16)
        rows += [centre + random_.normal(size=16) * random_.choice([0.0, 0.05, 0.2]) for _ in range(random_.integers(1, 30))]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(rows)]
    rows += [(900, [2 * x for x in rows[0][1]]), (901, rows[3][1]), (901, rows[3][1]), (902, [0.0] * 16), (903, None),
             (904, []), (905, [1.0, None]), (906, [float("nan")] * 16), (907, [1.0, 2.0, 3.0]), (908, [2.0, 4.0, 6.0]),
             (None, rows[5][1]), (910, [float("inf")] * 16), (911, [1e300] * 16), (912, [1e-300] * 16)]
    monkeypatch.setattr(vectors, "BLOCK", 8)
    table = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = rows_of(vectors.near_duplicates(table, tables=10), "vec_id", "n_links", "component_id", "kept")
    assert got == plain_vectors(rows)
    assert vectors.near_duplicates(table.limit(0)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(vectors.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(vectors.hadamard(vectors.hadamard(x)), x)


# ---- 5


def test_tokens_round_trip(spark, docs):
    random.seed(1)
    alphabet = ["a", "é", "word", " ", " ", "\n", ".", ",", "'", "s", "12", "\t", "ª", "<|endoftext|>", "日本", "it's", "!"]
    pairs = [(k, "".join(random.choices(alphabet, k=random.randint(0, 60)))) for k in range(120)]
    pairs += [(500, None), (501, ""), (502, "long " * 5000), (7, "again"), (7, "again")]
    random.shuffle(pairs)
    plain = Tokenizer.from_file(default_tokenizer())
    order = sorted(((k, t or "") for k, t in pairs), key=lambda p: (p[0], zlib.crc32(p[1].encode())))
    ids = [[*plain.encode(t, add_special_tokens=False).ids, 2] for _, t in order]
    for shard_bytes in (1 << 20, 4000):
        folder = new_folder(spark, "test")
        index = tokens.write_tokens(docs(pairs), folder, default_tokenizer(), length=32, shard_bytes=shard_bytes)
        want, start = [], 0
        for (k, _), one in zip(order, ids):
            want.append((k, start, len(one), zlib.crc32(np.array(one, "<u4").tobytes())))
            start += len(one)
        got = rows_of(tokens.read_documents(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
        assert got == sorted(want, key=repr)
        stream = []
        for shard in sorted({r["shard"] for r in index.select("shard").collect()}):
            opened = tokens.Shard(folder, shard)
            rows = sum(opened.file.get_batch(b).num_rows for b in range(opened.file.num_record_batches))
            for row in range(rows):
                values, mask = opened.sequence(row)
                assert len(values) == len(mask) == 32
                stream += values[mask].tolist()
            opened.close()
        assert stream == [x for one in ids for x in one]
    assert tokens.write_tokens(docs([]), new_folder(spark, "test"), default_tokenizer()).count() == 0


def test_encoder_equals_library():
    random.seed(2)
    encoder = tokens.Encoder(default_tokenizer())
    alphabet = list("aZé,.'! \n\t1ª<x_-") + ["\n", " ", "The", "42", " ", " ", "ß", "×"]
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 15))) for _ in range(4000)]
    assert encoder.encode(texts) == encoder.whole(texts)


# ---- 6


def plain_classes(pairs, over=90, of=100):
    sets = []
    for _, text in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append(frozenset(zip(w, w[1:], w[2:])) if len(w) >= 3 else frozenset([tuple(w)] if w else []))
    head = list(range(len(pairs)))

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (pairs[a][0], pairs[b][0]):
                both = len(sets[a] & sets[b])
                if of * both >= over * (len(sets[a]) + len(sets[b]) - both):
                    head[max(root(a), root(b))] = min(root(a), root(b))
    smallest = {}
    for at, (number, _) in enumerate(pairs):
        if number is not None:
            smallest[root(at)] = min(number, smallest.get(root(at), number))
    return sorted(((n, len(s), smallest.get(root(at)) if n is not None else None)
                   for at, ((n, _), s) in enumerate(zip(pairs, sets))), key=repr)


def near_copies(seed, families, copies, size):
    random.seed(seed)
    words = [f"w{k}" for k in range(4000)]
    passage = random.choices(words, k=40)
    pairs = []
    for _ in range(families):
        base = random.choices(words, k=random.randint(5, size)) + passage
        for _ in range(random.randint(1, copies)):
            copy = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 3, 5])):
                copy[random.randrange(len(copy))] = random.choice(words)
            pairs.append((len(pairs), " ".join(copy[: len(copy) - random.choice([0, 0, 1, 3])])))
    random.shuffle(pairs)
    return pairs


def test_jaccard_against_plain(docs):
    pairs = near_copies(4, 25, 14, 150)
    pairs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "One two"), (2004, "one TWO"), (2005, "one two three"),
              (2006, "ONE two  three"), (None, pairs[0][1]), (5, dict(pairs)[5]), (2007, "x " * 3000), (2008, "x " * 50)]
    want = plain_classes(pairs)
    table = docs(pairs).withColumnRenamed("n_chars", "n_shingles")
    got = ngram_join.jaccard_classes(table)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == want
    blocks = ngram_join.jaccard_classes(table, block_elements=2000, block_sets=4)  # many blocks, two rounds
    assert rows_of(blocks, "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.jaccard_classes(docs([])).count() == 0


def test_jaccard_of_short_texts(docs):
    random.seed(12)
    pairs = [(1, " ".join(f"w{k}" for k in range(11))), (2, " ".join(f"w{k}" for k in range(12)))]  # 9 and 10 shingles
    for family in range(40):
        base = [f"v{family}x{k}" for k in range(random.randint(4, 24))]
        for _ in range(4):
            first = random.choice([0, 0, 1])
            pairs.append((100 + len(pairs), " ".join(base[first : len(base) - random.choice([0, 1, 2])])))
    for over in (90, 80, 75):
        got = ngram_join.jaccard_classes(docs(pairs).withColumnRenamed("n_chars", "n_shingles"), over=over)
        assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_classes(pairs, over)
    assert rows_of(ngram_join.one_per_class(docs(pairs[:2])), "doc_id") == [(1,)]


def test_one_per_class(docs):
    text = " ".join(f"w{k}" for k in range(100))
    table = docs([(3, text), (1, text), (2, text + " more"), (9, "other words here"), (9, "other words here"),
                  (None, "no id"), (None, "no id"), (11, None), (12, None)])
    kept = ngram_join.one_per_class(table)
    assert kept.columns == table.columns
    assert rows_of(kept, "doc_id") == sorted([(1,), (9,), (11,), (12,), (None,), (None,)], key=repr)


def test_one_per_class_of_repeated_ids(docs):
    text = " ".join(f"w{k}" for k in range(100))
    own = "a text that nobody else has " * 3
    table = docs([(1, text), (5, text + " more"), (5, own), (7, text), (7, None)])
    assert rows_of(ngram_join.one_per_class(table), "doc_id", "text") == sorted([(1, text), (5, own), (7, None)], key=repr)


def test_trie_walk_against_pairs():
    random.seed(8)
    for _ in range(60):
        count = random.randint(2, 25)
        base = random.sample(range(60), 30)
        sets = []
        for _ in range(count):
            one = set(base if random.random() < 0.7 else random.sample(range(60), 30))
            one ^= set(random.sample(range(60), random.randint(0, 3)))
            sets.append(np.array(sorted(one)))
        sizes = np.array([len(s) for s in sets])
        side = np.array([random.randint(0, 1) for _ in sets])
        for cross in (False, True):
            made = ngram_join.linked_sets(sets, sizes, side, cross, list(range(count)), 90, 100)
            head = list(range(count))

            def root(x):
                while head[x] != x:
                    x = head[x]
                return x

            want = list(range(count))
            for a in range(count):
                for b in range(a):
                    both = len(set(sets[a]) & set(sets[b]))
                    if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both) and (not cross or side[a] != side[b]):
                        x, y = root(a), root(b)
                        head[max(x, y)] = min(x, y)
            want = [root(k) for k in range(count)]
            head = list(range(count))
            for a, b in made:
                x, y = root(a), root(b)
                head[max(x, y)] = min(x, y)
            assert [root(k) for k in range(count)] == want


# ---- 8


def plain_lines(pairs, min_docs):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    count = collections.Counter()
    for _, text in pairs:
        count.update({key(line) for line in (text or "").split("\n")})
    found = []
    for number, text in pairs:
        all_lines = (text or "").split("\n")
        kept = [line for line in all_lines if not key(line) or count[key(line)] < min_docs]
        found.append((number, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(found, key=repr)


def test_lines_against_plain(docs):
    random.seed(6)
    pool = ["Common line", " common LINE\t", "rare", "", "  ", "Ünï", "ünï", "x" * 500]
    pairs = [(k, "\n".join(random.choices(pool + [f"own {k}"], k=random.randint(0, 8)))) for k in range(60)]
    pairs += [(70, None), (71, ""), (72, "Common line"), (None, "Common line\nstays"), (3, pairs[3][1])]
    table = docs(pairs)
    index = lines.LineIndex(table.sparkSession, new_folder(table.sparkSession, "t"), min_docs=5).insert(table)
    columns = ["doc_id", "kept_text", "n_lines", "n_dropped"]
    want = plain_lines(pairs, 5)
    assert rows_of(index.apply(table), *columns) == want
    assert rows_of(index.apply(table, broadcast_keys=0), *columns) == want  # beyond the broadcast
    assert index.apply(table).columns == [*table.columns, "kept_text", "n_lines", "n_dropped"]
    assert lines.dedup_lines(docs([])).count() == 0


def test_line_index_is_reversible(spark, docs):
    first = docs([(k, f"shared a\nshared b\nown {k}") for k in range(6)])
    second = docs([(k, f"shared b\nshared c\nown {k}") for k in range(10, 16)])
    start = lines.LineIndex(spark, new_folder(spark, "t"), min_docs=6, shards=3).insert(first)
    both = start.insert(second)
    back = both.delete(second)
    assert rows_of(back.refcounts(), "key", "n_docs") == rows_of(start.refcounts(), "key", "n_docs")
    both_keys = {hashlib.blake2b(t.encode(), digest_size=16).digest() for t in ("shared a", "shared b", "shared c")}
    assert {bytes(r["key"]) for r in both.repeated().collect()} == both_keys
    held = {r["shard"]: lines.CuckooFilter.read(bytes(r["buckets"])) for r in both.filters().collect()}
    assert all(held[lines.shard_of(key, 3)].holds(key) for key in both_keys)
    gone = both_keys - {bytes(r["key"]) for r in back.repeated().collect()}
    assert len(gone) == 1
    assert rows_of(both.delete(first).delete(second).refcounts(), "key") == []


def test_cuckoo_filter():
    keys = [hashlib.blake2b(str(k).encode(), digest_size=16).digest() for k in range(5000)]
    held = lines.CuckooFilter.of(keys[:3000])
    assert all(held.holds(k) for k in keys[:3000])
    assert sum(held.holds(k) for k in keys[3000:]) < 10
    assert all(held.delete(k) for k in keys[:1500])
    assert all(held.holds(k) for k in keys[1500:3000])
