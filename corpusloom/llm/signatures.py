"""Operator 11: ranked lexical search over bit-sliced Bloom signatures.

*Index.*  A document's entries are its distinct terms and, for a term of ``tf`` occurrences, the
levels 1 to ``floor(log2 tf)`` of it.  Documents of about as many entries form blocks; a block is a
matrix of bits whose rows are the positions of a Bloom filter and whose columns are its documents,
so one row is a bitmap over documents.  The index also keeps the exact length of every document
and the exact number of documents of every term.

*Search.*  The rows of a term's positions, ANDed, are a bitmap of all documents that hold it and of
few others.  Level ``l`` allows ``2^(l+1) - 1`` occurrences, so each level's bitmap has a weight, what
these may add to the score at the document's exact length; their sum over the terms of an item is an
upper bound of the score.  The documents of the highest bounds are scored exactly from their texts,
which gives every item a score that its last hit has to reach; then every document whose bound
reaches it is scored exactly.  Documents left out are those that provably rank lower.

Items are read in blocks of a bounded number of terms.  Rows of documents are documents: rows of
equal id and text are scored each.  Items of equal id and text are one item, items of equal ids and
different texts are ranked each on their own.  Null and empty texts, and items without a term of
the corpus, have no hits.  A document without an id takes part and comes first among equals.
Empty tables give an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_IDS, bounded, new_folder, stored

POSITIONS = 7
BITS_PER_ENTRY = 12
# Documents of one block: at most so many, and so few that its matrix has about so many bits.
BLOCK_DOCS = 512
BLOCK_BITS = 1 << 24
# Terms that a task counts before it hands the counts on.
COUNTED = 200_000
# Documents of the highest bounds that are scored first, for each hit wanted.
PROBES = 4
# Distinct terms of items in one block of items.
ITEM_TERMS = 200_000

# ASCII letters and digits and all bytes above ASCII stay, A-Z as a-z; the rest becomes a space.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return (text or "").encode().translate(_KEPT).split()


def positions(hashes: np.ndarray, rows: int) -> np.ndarray:
    """Rows of each entry's hash, one line an entry; ``rows`` is a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    at = hashes[:, None] + step[:, None] * np.arange(POSITIONS, dtype=np.uint64)
    return ((at ^ (at >> np.uint64(29))) & np.uint64(rows - 1)).astype(np.int64)


def entry_hash(term: bytes, level: int) -> int:
    return xxhash.xxh3_64_intdigest(term, level)


class _Block:
    """Documents of one size class that wait for their matrix."""

    def __init__(self, size: int):
        self.rows = 1 << max(6, math.ceil(math.log2(BITS_PER_ENTRY)) + size)
        self.limit = max(8, min(BLOCK_DOCS, BLOCK_BITS // self.rows))
        self.ids: list = []
        self.marks: list[int] = []
        self.lengths: list[int] = []
        self.entries: list[np.ndarray] = []

    def matrix(self) -> bytes:
        wide = -(-len(self.ids) // 8)
        bits = np.zeros(self.rows * wide, np.uint8)
        for column, hashes in enumerate(self.entries):
            at = np.unique(positions(hashes, self.rows)) * wide + (column >> 3)
            bits[at] |= np.uint8(0x80 >> (column & 7))
        return bits.tobytes()


def _size_class(entries: int) -> int:
    return max(0, (entries - 1).bit_length())


def _parts_schema(docs: DataFrame) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (f"matrix_rows int, ids array<{kind}>, marks array<long>, lengths array<long>, bits binary, "
            "terms array<string>, counts array<long>")


class SignatureIndex:
    """The tables of an index in a folder: blocks of signatures, and documents per term."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def blocks(self) -> DataFrame:
        found = self.spark.read.parquet(os.path.join(self.folder, "parts"))
        return found.where(F.col("ids").isNotNull()).select("matrix_rows", "ids", "marks", "lengths", "bits")

    def terms(self) -> DataFrame:
        return self.spark.read.schema("term string, n_docs long").parquet(os.path.join(self.folder, "terms"))

    def totals(self) -> tuple[int, int]:
        """Documents that have a term, and all their terms with repeats."""
        lengths = self.blocks().select(F.size("lengths").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y).alias("sum"))
        row = lengths.agg(F.sum("n"), F.sum("sum")).first()
        return row[0] or 0, row[1] or 0


def build_index(docs: DataFrame, folder: str | None = None) -> SignatureIndex:
    """Index every row of ``docs`` in one pass over the texts, without moving them."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "signatures")
    schema = _parts_schema(docs)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, _Block] = {}
        held: Counter = Counter()
        layout: pa.Schema | None = None

        def block_row(block: _Block) -> pa.RecordBatch:
            return row([block.rows, block.ids, block.marks, block.lengths, block.matrix(), None, None])

        def count_row() -> pa.RecordBatch:
            made = row([None, None, None, None, None, [t.decode() for t in held], list(held.values())])
            held.clear()
            return made

        def row(values: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, layout.types)], schema=layout)

        for batch in batches:
            if layout is None:
                longs = pa.list_(pa.int64())
                layout = pa.schema([
                    ("matrix_rows", pa.int32()), ("ids", pa.list_(batch.schema.field("doc_id").type)), ("marks", longs),
                    ("lengths", longs), ("bits", pa.binary()), ("terms", pa.list_(pa.string())), ("counts", longs),
                ])
            ids, marks, texts = (batch.column(name) for name in ("doc_id", "mark", "text"))
            for at in range(batch.num_rows):
                terms = terms_of(texts[at].as_py())
                if not terms:
                    continue
                counts = Counter(terms)
                held.update(counts.keys())
                entries = [entry_hash(term, 0) for term in counts]
                entries += [entry_hash(t, level) for t, n in counts.items() if n > 1 for level in range(1, n.bit_length())]
                size = _size_class(len(entries))
                block = waiting.setdefault(size, _Block(size))
                block.ids.append(ids[at].as_py())
                block.marks.append(marks[at].as_py())
                block.lengths.append(len(terms))
                block.entries.append(np.array(entries, np.uint64))
                if len(block.ids) == block.limit:
                    yield block_row(waiting.pop(size))
                if len(held) >= COUNTED:
                    yield count_row()
        for block in waiting.values():
            yield block_row(block)
        if held:
            yield count_row()

    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").where(F.length("text") > 0)
    marked.mapInArrow(indexed, schema).write.mode("overwrite").parquet(os.path.join(folder, "parts"))
    parts = spark.read.schema(schema).parquet(os.path.join(folder, "parts")).where(F.col("terms").isNotNull())
    pairs = parts.select(F.explode(F.arrays_zip("terms", "counts")).alias("one"))
    terms = pairs.groupBy(F.col("one.terms").alias("term")).agg(F.sum("one.counts").alias("n_docs"))
    terms.write.mode("overwrite").parquet(os.path.join(folder, "terms"))
    return SignatureIndex(spark, folder)


def _gain(tf, m):
    """What ``tf`` occurrences in a document of length factor ``m`` give, before the term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Questions:
    """A block of items as arrays: terms, weights, and the scores that the hits have to reach."""

    def __init__(self, rows: list, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.terms = sorted({row["term"].encode() for row in rows})
        self.place = {term: k for k, term in enumerate(self.terms)}
        held = {row["term"].encode(): row["n_docs"] for row in rows}
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1))) for term in self.terms]
        own: dict[tuple, list] = {}
        for row in rows:
            k = self.place[row["term"].encode()]
            own.setdefault((row["item_id"], row["mark"]), []).append((k, weight[k] * row["times"]))
        self.items = [key[0] for key in own]
        self.uses = [(np.array([k for k, _ in x]), np.array([w for _, w in x], np.int64)) for x in own.values()]
        self.hashes: dict[int, np.ndarray] = {}

    def factor(self, n):
        return 25 + (75 * n * self.n_docs) // self.n_terms

    def level_hashes(self, level: int) -> np.ndarray:
        if level not in self.hashes:
            self.hashes[level] = np.array([entry_hash(term, level) for term in self.terms], np.uint64)
        return self.hashes[level]

    def bounds(self, rows: int, bits: bytes, lengths: np.ndarray) -> np.ndarray:
        """Upper bounds of all items' scores in all documents of a block: weighted sums of slices."""
        count = len(lengths)
        matrix = np.frombuffer(bits, np.uint8).reshape(rows, -1)
        m = self.factor(lengths)
        gains = np.zeros((len(self.terms), count))
        asked, present, level = np.arange(len(self.terms)), None, 0
        longest = int(lengths.max(initial=0))
        while len(asked) and 1 << level <= longest:
            found = matrix[positions(self.level_hashes(level)[asked], rows)]
            slices = np.bitwise_and.reduce(found, axis=1)
            if present is not None:
                slices &= present
            some = slices.any(axis=1)
            asked, present = asked[some], slices[some]
            most, less = (np.minimum(lengths, (1 << x) - 1) for x in (level + 1, level))
            weight = (_gain(most, m) - _gain(less, m)).astype(float)
            gains[asked] += np.unpackbits(present, axis=1, count=count) * weight
            level += 1
        return np.stack([weights.astype(float) @ gains[places] for places, weights in self.uses])

    def scores(self, text: str, wanted: list[int]) -> list[int]:
        """The exact scores of ``wanted`` items in a text."""
        terms = terms_of(text)
        gains = np.zeros(len(self.terms), np.int64)
        if terms:
            m = self.factor(len(terms))
            for k, tf in Counter(k for term in terms if (k := self.place.get(term)) is not None).items():
                gains[k] = _gain(tf, m)
        return [int(self.uses[one][1] @ gains[self.uses[one][0]]) for one in wanted]


def _item_terms(items: DataFrame) -> DataFrame:
    """``item_id``, ``mark``, ``term``, ``times`` of every distinct item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                counts = Counter(terms_of(batch.column("text")[at].as_py()))
                one = batch.slice(at, 1)
                repeat = pa.array(np.zeros(len(counts), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [one.column("item_id").take(repeat), one.column("mark").take(repeat),
                     pa.array([t.decode() for t in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["item_id", "mark", "term", "times"],
                )

    distinct = items.select("item_id", "text", F.xxhash64("text").alias("mark")).distinct()
    return distinct.mapInArrow(split, f"item_id {kind}, mark long, term string, times long")


CANDIDATES = "item int, mark long, bound double"


def _by_bounds(index: SignatureIndex, state, kind: str, top: int | None) -> DataFrame:
    """Documents by their bounds: of each item the ``top`` highest of every task, or all that reach its need."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions, need = state.value
        best: list[list[tuple]] = [[] for _ in questions.items]
        names = ["item", "mark", "bound", "doc_id"]

        def batch_of(rows: list[tuple], ids_type) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.float64(), ids_type]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        ids_type = None
        for batch in batches:
            ids_type = batch.schema.field("ids").type.value_type
            for at in range(batch.num_rows):
                lengths = batch.column("lengths")[at].values.to_numpy()
                bounds = questions.bounds(batch.column("matrix_rows")[at].as_py(), batch.column("bits")[at].as_py(), lengths)
                ids, marks = batch.column("ids")[at].as_py(), batch.column("marks")[at].as_py()
                if top is None:
                    items, docs = np.nonzero((bounds > 0) & (bounds >= need[:, None]))
                    if len(items):
                        yield batch_of([(i, marks[d], bounds[i, d], ids[d]) for i, d in zip(items.tolist(), docs.tolist())], ids_type)
                    continue
                cut = max(0, bounds.shape[1] - top)
                order = np.argpartition(bounds, cut, axis=1)[:, cut:] if cut else np.tile(np.arange(bounds.shape[1]), (len(bounds), 1))
                for i, columns in enumerate(order):
                    own = [(float(bounds[i, d]), marks[d], ids[d]) for d in columns.tolist() if bounds[i, d] > 0]
                    if own:
                        best[i] = sorted(best[i] + own, key=lambda x: -x[0])[:top]
        rows = [(i, mark, bound, one) for i, own in enumerate(best) for bound, mark, one in own]
        if rows:
            yield batch_of(rows, ids_type)

    return index.blocks().mapInArrow(found, f"{CANDIDATES}, doc_id {kind}")


def _scored(docs: DataFrame, candidates: DataFrame, state, label: str) -> DataFrame:
    """Exact scores of candidate pairs; the texts move only if the documents are many."""
    wanted = stored(candidates.groupBy("doc_id", "mark").agg(F.collect_set("item").alias("items")), label)
    listed = wanted.select(F.struct("doc_id", "mark").alias("key"), "items")
    if bounded(listed, BROADCAST_IDS):
        listed = F.broadcast(listed)
    texts = docs.select("doc_id", "text", F.struct("doc_id", F.xxhash64("text").alias("mark")).alias("own"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = texts.join(listed, F.col("own").eqNullSafe(F.col("key"))).select("doc_id", "text", "items")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions, _ = state.value
        for batch in batches:
            items, at, scores = [], [], []
            for row in range(batch.num_rows):
                wanted = batch.column("items")[row].as_py()
                items += wanted
                at += [row] * len(wanted)
                scores += questions.scores(batch.column("text")[row].as_py(), wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int32()), batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(scores, pa.int64())],
                names=["item", "doc_id", "score"],
            )

    return joined.mapInArrow(scored, f"item int, doc_id {kind}, score long").where("score > 0")


def _first(rows: DataFrame, limit: int, *order) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= limit)


def search(index: SignatureIndex, docs: DataFrame, items: DataFrame, hits: int = 10,
           item_terms: int = ITEM_TERMS) -> DataFrame:
    """The ``hits`` highest-scoring documents of each item: item_id, rank, doc_id, score.

    ``docs`` are the rows that ``index`` was built of.
    """
    spark = index.spark
    n_docs, n_terms = index.totals()
    asked = _item_terms(items).join(index.terms(), "term")
    asked = stored(asked, "asked")
    parts = max(1, math.ceil(asked.count() / item_terms))
    part = F.pmod(F.xxhash64("item_id", "mark"), F.lit(parts))
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    for number in range(parts):
        rows = asked.where(part == number).collect()
        if rows:
            found = found.unionByName(_answer(index, docs, Questions(rows, n_docs, n_terms), hits, item_kind))
    return found


def _answer(index: SignatureIndex, docs: DataFrame, questions: Questions, hits: int, item_kind: str) -> DataFrame:
    spark = index.spark
    kind = docs.schema["doc_id"].dataType.simpleString()
    need = np.zeros(len(questions.items))
    state = spark.sparkContext.broadcast((questions, need))
    probes = _first(_by_bounds(index, state, kind, PROBES * hits), PROBES * hits, F.desc("bound"), F.asc("mark"))
    last = _first(_scored(docs, probes, state, "probes"), hits, F.desc("score"), F.asc("doc_id")).where(F.col("rank") == hits)
    for row in last.select("item", "score").collect():
        need[row["item"]] = row["score"]
    state = spark.sparkContext.broadcast((questions, need))
    scored = _scored(docs, _by_bounds(index, state, kind, None), state, "candidates")
    best = _first(scored, hits, F.desc("score"), F.asc("doc_id"))
    names = questions.items

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [names[k] for k in batch.column("item").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kinds[0]), *[batch.column(c) for c in ("rank", "doc_id", "score")]], names=["item_id", "rank", "doc_id", "score"]
            )

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long").schema
    kinds = to_arrow_schema(schema).types
    return best.select("item", "rank", "doc_id", "score").mapInArrow(named, schema)
