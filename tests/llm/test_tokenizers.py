"""Operators on tokenizers, against the public libraries: 12 and 13."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from corpusloom.llm import align, bpe
from corpusloom.llm.queries import QUERIES

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
LETTERS = list("abAB '’\n\t .,é漢字のअर01▁\x1c\x85 ") + ["the", " and", "'s", "😀", "\r\n", "ing"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts_of(seed, count):
    random.seed(seed)
    made = ["".join(random.choices(LETTERS, k=random.randint(0, 40))) for _ in range(count)]
    made += ["".join(chr(random.choice([random.randrange(0x20, 0x3000), random.randrange(0x10000, 0x20000)]))
                     for _ in range(20)) for _ in range(count // 4)]
    return made + ["", " ", "a" * 3000, "ab " * 2000, "\n" * 500, "xq" * 1500]


# ---- 12


def test_transducer_against_library(library):
    encoder = bpe.Encoder(RANKS, P.PATTERN, remembered=50)
    encoder.transducer.max_states = 300  # starts anew many times, within pieces too
    for text in texts_of(1, 400):
        assert np.frombuffer(encoder.encode(text), "<i4").tolist() == library.encode_ordinary(text), text


def test_pairs_against_merges(ranks):
    random.seed(2)
    machine = bpe.MergeTransducer(ranks)
    short = [one for one in machine.token if len(machine.token[one]) <= 3]
    for pool in (short, list(machine.token)):
        for before, token in zip(random.choices(pool, k=1500), random.choices(pool, k=1500)):
            both = machine.merged(machine.token[before] + machine.token[token])
            assert machine._follows(before, token) == (both == [before, token])


def test_output_waits_no_longer_than_a_token(ranks, library):
    machine = bpe.MergeTransducer(ranks)
    longest = max(map(len, ranks))
    for text in ["hippopotamuses" * 30, "thinkingabout" * 20, "zzzzqqqq" * 30, "漢字" * 40]:
        state, out, data = machine.start, [], text.encode()
        for at in range(len(data)):
            state = machine.read(state, data[at : at + 1], out)
            decided = sum(len(machine.token[one]) for one in out)
            assert at + 1 - decided <= longest + 1
        assert out + list(machine.rest(state)) == machine.encode(data)


def test_other_vocabularies():
    letters = {bytes([b]): b for b in range(256)}
    machine = bpe.MergeTransducer(letters | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259})
    assert machine.encode(b"abcab") == [258, 256] and machine.encode(b"bcbc") == [257, 257]
    assert machine.encode(b"xyz") == [259]  # no merge makes it; only a whole piece is this token
    assert machine.encode(b"xyzab") == [*b"xyz", 256]
    with pytest.raises(ValueError):
        bpe.MergeTransducer({b"a": 0})


def test_stream_decoder(ranks):
    random.seed(3)
    table, closed = bpe.StreamDecoder.table_of(ranks)
    for turn in range(600):
        ids = np.array(random.choices(range(256) if turn % 2 else range(len(table)), k=random.randint(0, 15)), np.int32)
        stream, step, seen = bpe.StreamDecoder(table, closed), random.randint(1, 5), []
        for at in range(0, len(ids), step):
            seen.append(stream.feed(ids[at : at + step]))
        whole = b"".join(table[one] for one in ids).decode("utf-8", "replace")
        assert "".join([*seen, stream.finish()]) == whole
    ids = [ranks[bytes([b])] for b in "é漢😀".encode()]
    stream = bpe.StreamDecoder(table, closed)
    assert [stream.feed(np.array([one])) for one in ids] == ["", "é", "", "", "漢", "", "", "", "😀"]


def plain_bpe(pairs, library):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    made = []
    for number, text in pairs:
        ids = library.encode_ordinary(text or "")
        made.append((number, len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode_bytes(ids))))
    return sorted(made, key=repr)


def test_byte_bpe_query(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op12_byte_bpe"](spark, small).collect()), key=repr) == plain_bpe(docs, library)


def test_byte_bpe_edges(spark, library):
    pairs = [(1, None), (1, ""), (None, "null id"), (2, "same"), (2, "same"), (3, "<|endoftext|> a'b"), (4, "word " * 40_000)]
    docs = spark.createDataFrame([(*p, "x", [1]) for p in pairs], "doc_id long, text string, ids string, closed array<int>")
    got = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS).collect()
    want = [(number, library.encode_ordinary(text or ""), text or "") for number, text in pairs]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(docs.limit(0), RANKS, P.PATTERN), RANKS).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(bpe.decode(odd, RANKS).collect()) == [(1, None, ""), (2, [], "")]


# ---- 13

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain_alignment(pairs):
    """Every text encoded whole, offsets compared one by one, links expanded."""
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    entries = {rank: entry for entry, rank in json.load(open(FILES[0]))["model"]["vocab"].items()}
    letters = align.byte_of_letter()

    def bytes_b(rank):
        piece = second.id_to_piece(rank)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(rank) else piece.replace("▁", " ").encode()

    made = []
    for number, text in pairs:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        parts_a = [bytes(letters[c] for c in entries[one]) for one in a]
        parts_b = [bytes_b(one) for one in b]
        groups = []
        if text and b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            x = y = start_x = start_y = size_a = size_b = 0
            while x < len(a):
                size_a += len(parts_a[x])
                x += 1
                while size_b < size_a:
                    size_b += len(parts_b[y])
                    y += 1
                if size_a == size_b:
                    groups.append((a[start_x:x], b[start_y:y]))
                    start_x, start_y = x, y
        made.append((number, groups))
    counts = Counter(pair for _, groups in made for pair in {(p, q) for g in groups for p in g[0] for q in g[1]})
    most = defaultdict(int)
    for (p, _), count in counts.items():
        most[p] = max(most[p], count)
    rows = []
    for number, groups in made:
        links = [(p, q) for g in groups for p in g[0] for q in g[1]]
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        rows.append((number, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                     sum(counts[link] == most[link[0]] for link in links), sum(counts[link] for link in links), written))
    return rows


def test_alignment_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest() if text else ""
    want = sorted((*row[:7], sha(row[7])) for row in plain_alignment(docs))
    assert sorted(map(tuple, QUERIES["op13_alignment"](spark, small).collect())) == want


def test_alignment_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(align, "CALL_CHARS", 100)
    monkeypatch.setattr(align, "WIDE", 3)
    texts = [None, "", *texts_of(5, 250), "ab<|endoftext|> <s> </s> x", "a\x00b c", "▁ a", "word ▁x", "same one", "same one",
             "漢字" * 2000, " lead", "trail ", "two  spaces", "line\n next \n", "x" * 5000 + " y"]
    pairs = list(enumerate(texts)) + [(3, "again"), (None, "no id")]
    docs = spark.createDataFrame([(*p, "x", 1) for p in pairs], "doc_id long, text string, block string, pair int").repartition(7)
    got = align.count_links(align.align(docs, *FILES))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=repr) == sorted(plain_alignment(pairs), key=repr)
    assert align.count_links(align.align(docs.limit(0), *FILES)).count() == 0


def test_wide_groups(monkeypatch):
    a, b = [5, 6, 5, 7], [9, 9, 8]
    plain = Counter(x << 32 | y for x in a for y in b)
    monkeypatch.setattr(align, "WIDE", 2)
    assert dict(zip(*align.links_of(a, b))) == plain
    assert align.group_ends([1, 2, 0, 3], [3, 1, 2]) == [(3, 3, 1), (6, 4, 3)]


def test_links_pass_columns_through(spark):
    rows = [(1, [1 << 32 | 2, 1 << 32 | 3], [4, 1], "a", 7), (2, [1 << 32 | 2], [1], "b", 8), (3, [], [], "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, pairs array<long>, times array<long>, block string, n_best int")
    got = align.count_links(docs)
    assert got.columns == ["doc_id", "block", "n_best", "count_sum"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", 4, 9), (2, "b", 1, 2), (3, "c", 0, 0)]
    counts = sorted(map(tuple, align.pair_counts(docs).collect()))
    assert counts == [(1, 2, 2), (1, 3, 1)]
