"""Operator 13: alignment of two tokenizers over the same text, and how often their ids are linked.

Tokenizer A is a byte-level BPE file, B a piece model that puts a space before the text, so A reads
space and text.  Both give token bytes; the ends of A's tokens are kept in a dictionary from end
to index, those of B in another, and the sorted keys that both hold slice the two id lists into
groups.  The links of a slice are all its pairs of an A and a B token.

A text is cut before every single space between two characters that are not white space.  Neither
tokenizer has a token across such a cut (A's pieces begin there, B has no piece with a space behind
another character, which is checked), so a chunk between two cuts is aligned once, many chunks in
one call of the libraries, and remembered for the texts that hold it again.

``align`` gives the groups and links of every text, ``count_links`` the number of documents that
hold each pair of ids linked.  For the counts, rows are taken in blocks of a few thousand: the
distinct pairs of a block fetch their counts through one join by pair and meet the rows of the
block again in order, so no table of pairs is held in one place and a common pair costs one row a
block.

A text that is null, empty, or whose bytes under A or B differ from space and text has no tokens:
all its numbers are 0 and its groups are an empty text.  Rows are documents, repeated ones too.
An empty table gives an empty one.  ``align`` reads ``doc_id`` and ``text`` and ignores the rest;
``count_links`` passes other columns through and replaces ``n_best`` and ``count_sum``.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import no_cycle_search, stored

# Chunks a worker remembers of either generation, and the longest chunk remembered.
REMEMBERED = 200_000
LONGEST = 48
# Text aligned in one call of the libraries, and text of one batch of a result, in characters.
CALL_CHARS = 1 << 16
BATCH_CHARS = 1 << 20
# Links of one group beyond which equal ids are counted before they are paired.
WIDE = 1 << 14
# Rows of one block are consecutive rows of a partition; two to the power of this.
BLOCK_BITS = 12

# The record of a chunk whose tokens have other bytes than the chunk.
UNLIKE = ()

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"

_cuts = re.compile(r"(?<=\S) (?=\S)").split
_STATE: dict = {}


def byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level files write bytes: printable ones stand for themselves, the
    others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokenizer:
    """A byte-level tokenizer file; strings of special tokens inside texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.bytes_of = {rank: bytes(map(letters.__getitem__, entry)) for entry, rank in vocabulary.items()
                         if all(letter in letters for letter in entry)}

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids


class PieceTokenizer:
    """A piece model with a space before the text and bytes for what has no piece."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = {}
        for rank in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(rank)
            if self.model.is_byte(rank):
                self.bytes_of[rank] = bytes([int(piece[3:-1], 16)])
            else:
                self.bytes_of[rank] = piece.replace("▁", " ").encode()
        self.cuts = not any(re.search("[^▁]▁", self.model.id_to_piece(k)) for k in self.bytes_of)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


def group_ends(lengths_a: Iterable[int], lengths_b: Iterable[int]) -> list[tuple[int, int, int]]:
    """Where tokens of both sides end: the offset, and how many tokens of A and of B end up to it."""
    ends_a = {end: index for index, end in enumerate(accumulate(lengths_a), 1)}
    ends_b = {end: index for index, end in enumerate(accumulate(lengths_b), 1)}
    return [(end, ends_a[end], ends_b[end]) for end in sorted(ends_a.keys() & ends_b.keys())]


def links_of(ids_a: list[int], ids_b: list[int]) -> tuple[list[int], list[int] | None]:
    """Pairs of ids of one group, A's in the upper 32 bits, and how often each is linked there (None: once)."""
    if len(ids_a) * len(ids_b) <= WIDE:
        return [a << 32 | b for a in ids_a for b in ids_b], None
    counts_a, counts_b = Counter(ids_a), Counter(ids_b)
    return ([a << 32 | b for a in counts_a for b in counts_b],
            [m * n for m in counts_a.values() for n in counts_b.values()])


def _sizes(bytes_of: dict[int, bytes]) -> list[int]:
    return [len(bytes_of.get(rank, b"")) for rank in range(max(bytes_of) + 1)]


class Aligner:
    """Aligns texts chunk by chunk, remembering the recent chunks."""

    def __init__(self, byte_file: str, piece_file: str, remembered: int = REMEMBERED):
        self.a, self.b = ByteTokenizer(byte_file), PieceTokenizer(piece_file)
        self.sizes_a, self.sizes_b = _sizes(self.a.bytes_of), _sizes(self.b.bytes_of)
        self.remembered = remembered
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _record(self, ids_a: list[int], ids_b: list[int], x: int, y: int, ends: list[tuple[int, int, int]]) -> tuple:
        """Numbers, groups and links of the tokens from ``x`` and ``y`` up to each of ``ends``."""
        groups, pairs, times, links = [], [], None, 0
        first_x, first_y = x, y
        for _, next_x, next_y in ends:
            if next_x == x + 1 and next_y == y + 1:
                a, b = ids_a[x], ids_b[y]
                groups.append(f"{a}|{b}")
                pairs.append(a << 32 | b)
                links += 1
            else:
                own_a, own_b = ids_a[x:next_x], ids_b[y:next_y]
                groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
                some, often = links_of(own_a, own_b)
                links += len(own_a) * len(own_b)
                if often is not None or times is not None:
                    times = (times or [1] * len(pairs)) + (often or [1] * len(some))
                pairs += some
            x, y = next_x, next_y
            if times is not None and len(times) < len(pairs):
                times.append(1)
        return (x - first_x, y - first_y, len(ends), links, ";".join(groups), array("q", pairs).tobytes(),
                None if times is None else array("q", times).tobytes())

    def _learn(self, chunks: list[str]) -> bool:
        """Align chunks side by side as one text; False if its bytes are not those of the tokens."""
        text = " ".join(chunks)
        ids_a, ids_b = self.a.encode(text), self.b.encode(text)
        data = (" " + text).encode()
        if b"".join(map(self.a.bytes_of.__getitem__, ids_a)) != data or b"".join(map(self.b.bytes_of.__getitem__, ids_b)) != data:
            return False
        ends = group_ends(map(self.sizes_a.__getitem__, ids_a), map(self.sizes_b.__getitem__, ids_b))
        at = end = x = y = 0
        for chunk in chunks:
            end += (len(chunk) if chunk.isascii() else len(chunk.encode())) + 1
            first = at
            while ends[at][0] < end:
                at += 1
            if ends[at][0] != end:
                raise ValueError("a token crosses the cut between two chunks")
            at += 1
            self.young[chunk] = self._record(ids_a, ids_b, x, y, ends[first:at])
            _, x, y = ends[at - 1]
        return True

    def _learn_all(self, chunks: Iterable[str]) -> None:
        waiting, size = [], 0
        for chunk in chunks:
            # White space at an end does not stand beside another chunk, and U+2581 is B's space.
            if not chunk or chunk[0].isspace() or chunk[-1].isspace() or "▁" in chunk:
                if not chunk or not self._learn([chunk]):
                    self.young[chunk] = UNLIKE
                continue
            waiting.append(chunk)
            size += len(chunk)
            if size > CALL_CHARS:
                self._flush(waiting)
                waiting, size = [], 0
        if waiting:
            self._flush(waiting)

    def _flush(self, chunks: list[str]) -> None:
        if not self._learn(chunks):
            for chunk in chunks:
                if not self._learn([chunk]):
                    self.young[chunk] = UNLIKE


    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: numbers of A tokens, B tokens, groups and links, the groups, pairs and their times."""
        cut = [[] if not text else _cuts(text) if self.b.cuts else [text] for text in texts]
        known = [list(map(self.young.get, chunks)) for chunks in cut]
        fresh = set()
        for chunks, records in zip(cut, known):
            if None in records:
                fresh.update([chunk for chunk, record in zip(chunks, records) if record is None])
        if fresh:
            for chunk in [chunk for chunk in fresh if chunk in self.old]:
                self.young[chunk] = self.old[chunk]
            self._learn_all(sorted(chunk for chunk in fresh if chunk not in self.old))
            known = [list(map(self.young.__getitem__, c)) if None in r else r for c, r in zip(cut, known)]
        found = list(map(self._joined, known))
        for chunk in fresh:
            if len(chunk) > LONGEST:
                del self.young[chunk]
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        return found

    @staticmethod
    def _joined(records: list) -> tuple:
        if not records or UNLIKE in records:
            none = np.zeros(0, np.int64)
            return 0, 0, 0, 0, "", none, none
        a, b, groups, links, texts, codes, times = zip(*records)
        pairs, total = np.frombuffer(b"".join(codes), np.int64), sum(links)
        if total == len(pairs):
            pairs, times = np.unique(pairs, return_counts=True)
        else:
            often = b"".join([t or np.ones(len(p) // 8, np.int64).tobytes() for p, t in zip(codes, times)])
            pairs, at = np.unique(pairs, return_inverse=True)
            summed = np.zeros(len(pairs), np.int64)
            np.add.at(summed, at, np.frombuffer(often, np.int64))
            times = summed
        return sum(a), sum(b), sum(groups), total, ";".join(texts), pairs, times


def _aligner(byte_file: str, piece_file: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    key = byte_file, piece_file
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = Aligner(*key)
    return _STATE[key]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int64)))


def align(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Tokens, groups and links of every text.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``.  ``pairs`` are the distinct linked ids of the text, A's
    in the upper 32 bits, and ``times`` how often each is linked.  The two files are paths that all
    executors have.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_search():
            yield from aligned_rows(batches)

    def aligned_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_file, piece_file)
        for batch in batches:
            texts, first = batch.column("text"), 0
            sizes = pa.compute.utf8_length(texts).to_pylist()
            while first < len(sizes):
                last, size = first, 0
                while last < len(sizes) and (last == first or size + sizes[last] <= BATCH_CHARS):
                    size += sizes[last]
                    last += 1
                a, b, groups, links, written, pairs, times = zip(*aligner.align(texts.slice(first, last - first).to_pylist()))
                numbers = [pa.array(column, pa.int64()) for column in (a, b, groups, links)]
                columns = [batch.column("doc_id").slice(first, last - first), *numbers,
                           pa.array(written, pa.string()), _lists(pairs), _lists(times)]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                first = last

    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(aligned, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ALIGNED}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``id_a``, ``id_b`` and the number of documents that hold them linked."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    return counts.select(F.shiftright("pair", 32).alias("id_a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("id_b"), "n_docs")


def count_links(aligned: DataFrame) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to rows with ``pairs`` and ``times``, which it drops.

    The count of a pair is the number of rows that hold it.  ``count_sum`` adds the counts over the
    row's links, ``n_best`` is the number of links whose count is the highest of their A id.
    """
    kept = [name for name in aligned.columns if name not in ("pairs", "times", "n_best", "count_sum")]
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block")
    rows = stored(aligned.select(block, F.struct(*kept).alias("doc"), "pairs", "times"), "aligned")
    held = stored(
        rows.select("block", F.explode("pairs").alias("pair")).groupBy("block", "pair").agg(F.count("*").alias("n")), "pairs"
    )
    counts = held.groupBy("pair").agg(F.sum("n").alias("count"))
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))
    known = counts.join(highest, F.shiftright("pair", 32) == F.col("a"))
    known = known.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    found = held.select("block", "pair").join(known, "pair").select("block", "pair", "count", "best")
    both = found.unionByName(rows, allowMissingColumns=True).repartition("block")
    laid = both.sortWithinPartitions("block", F.col("pair").isNull(), "pair").select("block", "pair", "count", "best", "doc", "pairs", "times")
    schema = rows.select("doc", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")).schema

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts = None, []
        table = None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            finds = batch.column("pair").is_valid().to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((blocks[1:] != blocks[:-1]) | (finds[1:] != finds[:-1])) + 1
            for first, last in zip([0, *turns.tolist()], [*turns.tolist(), len(blocks)]):
                if first == last:
                    continue
                if blocks[first] != here:
                    here, parts, table = blocks[first], [], None
                run = batch.slice(first, last - first)
                if finds[first]:
                    parts.append([run.column(name).to_numpy(zero_copy_only=False) for name in ("pair", "count", "best")])
                    continue
                if table is None:
                    table = [np.concatenate(column) for column in zip(*parts)] or [np.zeros(0, np.int64)] * 3
                lists = run.column("pairs")
                sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
                at = np.searchsorted(table[0], lists.flatten().to_numpy())
                times = run.column("times").flatten().to_numpy()
                starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                sums = []
                for weight in (table[2], table[1]):
                    running = np.concatenate([np.zeros(1, np.int64), np.cumsum(weight[at].astype(np.int64) * times)])
                    sums.append(pa.array(running[starts[1:]] - running[starts[:-1]]))
                yield pa.RecordBatch.from_arrays([run.column("doc"), *sums], names=["doc", "n_best", "count_sum"])

    return laid.mapInArrow(summed, schema).select("doc.*", "n_best", "count_sum")
