"""Operator 12: byte-level BPE as a lazily determinised transducer, and its streaming decoder.

*Encoding.*  A sequence of tokens is the encoding of its bytes if and only if every token is the
encoding of its own bytes and every two neighbours are the encoding of theirs: merges run lowest
rank first, so the first merge across a boundary would also happen in the two neighbours alone.
That makes the merges a transducer over bytes.  A path is (tokens closed so far, node of the
vocabulary's trie that the open token has reached); reading a byte moves every path along the trie
and closes its token where the node is one that may follow the token before.  ``MergeTransducer``
determinises it as texts are read: a state is the set of live paths, without the tokens they
share, which are put out at once.  So output waits only for the bytes in which paths still differ,
and no path is longer than the longest token.  Exactly one path has no open token: it gives the
rest at the end.

*Decoding.*  ``StreamDecoder`` takes ids in slices of any size and gives text as soon as
characters are complete.  Its state is that of a UTF-8 machine and the bytes of the open
character; tokens that begin and end between characters take no step of it.  Bytes that are not
UTF-8 become U+FFFD as in Python's ``errors="replace"``.

A null or empty text has no tokens.  Rows keep their order within a partition, repeated ids and
rows included, so an empty table gives an empty one; input columns other than ``doc_id`` and the
text are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import no_cycle_search

# States a transducer holds before it starts anew, and pieces a worker remembers of either
# generation; neither changes a result.
MAX_STATES = 150_000
REMEMBERED = 250_000
# Nodes with at most so many tokens below them tell tokens before them apart only by what may follow.
CLASS_WIDTH = 6
ANY = -2
# Bytes of text or of ids in one batch of a result.
BATCH_BYTES = 4 << 20

_STATE: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its id a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class MergeTransducer:
    """Merges of a vocabulary as a deterministic transducer that grows with what it reads."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
        self.ranks, self.max_states = ranks, max_states
        self.token = {rank: token for token, rank in ranks.items()}
        # The trie: node and byte -> node, and the token that a node ends, if any.
        self.down: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.down.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = rank
        self.inner = bytearray(len(self.ends))
        above = [0] * len(self.ends)
        for key, node in self.down.items():
            self.inner[key >> 8] = 1
            above[node] = key >> 8
        self.below: list[list[int]] = [[] for _ in self.ends]
        for node, rank in enumerate(self.ends):
            while rank >= 0 and (node := above[node]):
                self.below[node].append(rank)
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        self.known: dict[tuple, int] = {}
        self.classes: dict = {}
        self.paths: list[tuple] = []
        self.moves: dict[int, tuple[int, tuple]] = {}
        self.start = self._number((((-1,), 0),))

    def merged(self, data: bytes) -> list[int]:
        """The merges applied one by one, lowest rank first: what the transducer is compiled from."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[part] for part in parts]

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a byte or for one that merges never make."""
        if token not in self.halves:
            data, last = self.token[token], None
            if self.merged(data) == [token] and len(data) > 1:
                cuts = [k for k in range(1, len(data)) if data[:k] in self.ranks and data[k:] in self.ranks]
                halves = ((self.ranks[data[:k]], self.ranks[data[k:]]) for k in cuts)
                last = next((x for x in halves if all(map(self._own, x)) and self._apart(*x, token)), None)
                if last is None or max(last) > token:
                    raise ValueError("a token of this vocabulary ranks before its parts")
            self.halves[token] = last
        return self.halves[token]

    def _own(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self._parts(token) is not None

    def _apart(self, before: int, token: int, limit: int = 1 << 60) -> bool:
        """Whether no merge of a rank below ``limit`` crosses the boundary of two tokens that stand alone.

        The merges of both are undone, the latest first.  What then meets at the boundary stood
        there until the merge undone, and would have merged if its own rank came before that; of
        equal ranks the one further left comes first.
        """
        while True:
            rank = self.ranks.get(self.token[before] + self.token[token])
            if rank is not None and rank < limit:
                return False
            left, right = self._parts(before), self._parts(token)
            if left is None and right is None:
                return True
            if right is None or (left is not None and before > token):
                limit, before = before, left[1]
            else:
                limit, token = token + 1, right[0]

    def _follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand behind ``before`` (-1: at the start)."""
        if not self._own(token):
            return False
        if before < 0:
            return True
        key = before << 32 | token
        if key not in self.pairs:
            if len(self.pairs) > 4 * self.max_states:
                self.pairs.clear()
            self.pairs[key] = self._apart(before, token)
        return self.pairs[key]

    def _number(self, paths: tuple) -> int:
        at = self.known.get(paths)
        if at is None:
            at = self.known[paths] = len(self.paths)
            self.paths.append(paths)
        return at

    def _grow(self, state: int, byte: int) -> tuple[int, tuple]:
        """The move from ``state`` on ``byte``: the next state and the tokens it puts out.

        Paths are ordered by where their open token begins; the one without an open token is last,
        and there is just one.
        """
        if len(self.paths) > self.max_states:
            here = self.paths[state]
            self._reset()
            state = self._number(here)
        paths, closed = [], None
        for tokens, node in self.paths[state]:
            node = self.down.get(node << 8 | byte)
            if node is None:
                continue
            if self.inner[node]:
                paths.append((tokens, node))
            token = self.ends[node]
            if token >= 0 and closed is None:
                last = tokens[-1]
                fits = self.pairs.get(last << 32 | token)
                if self._follows(last, token) if fits is None else fits:
                    closed = (*tokens, token), 0
        paths.append(closed)
        out: tuple = ()
        while True:
            first, shared = paths[0][0], 0
            while all(len(tokens) > shared + 1 and tokens[shared + 1] == first[shared + 1] for tokens, _ in paths):
                shared += 1
            if shared:
                out += first[1 : shared + 1]
                paths = [(tokens[shared:], node) for tokens, node in paths]
            tokens, node = paths[0]
            before = tokens[0]
            if len(tokens) > 1:
                before = ANY
            elif node and len(self.below[node]) <= CLASS_WIDTH:
                before = self._class(before, node)
                if before is None:
                    del paths[0]
                    continue
            break
        if before != tokens[0]:
            paths = [((before, *tokens[1:]), node) for tokens, node in paths]
        move = self.moves[state << 8 | byte] = self._number(tuple(paths)), out
        return move

    def _class(self, before: int, node: int) -> int | None:
        """One token that stands for all those behind which the same tokens below ``node`` may follow."""
        key = before << 32 | node
        if key not in self.classes:
            fitting = tuple([t for t in self.below[node] if self._follows(before, t)])
            self.classes[key] = self.classes.setdefault((node, fitting), before) if fitting else None
        return self.classes[key]

    def read(self, state: int, data: bytes, out: list[int]) -> int:
        """Read bytes from ``state``, appending what is decided to ``out``; the state reached."""
        moves = self.moves
        for byte in data:
            try:
                state, decided = moves[state << 8 | byte]
            except KeyError:
                state, decided = self._grow(state, byte)
                moves = self.moves
            if decided:
                out.extend(decided)
        return state

    def rest(self, state: int) -> tuple:
        """The tokens still held back if the piece ends in ``state``."""
        return self.paths[state][-1][0][1:]

    def encode(self, data: bytes) -> list[int]:
        """The tokens of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        out: list[int] = []
        out.extend(self.rest(self.read(self.start, data, out)))
        return out


class Encoder:
    """Cuts texts into pieces and sends each piece through the transducer, remembering the recent ones."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        self.transducer = MergeTransducer(load_ranks(path))
        self.cut = regex.compile(pattern).findall
        self.remembered = remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, piece: str) -> bytes:
        ids = self.young.get(piece)  # learned since, from the same text
        if ids is not None:
            return ids
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self.young) >= self.remembered:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        pieces = self.cut(text)
        ids = list(map(self.young.get, pieces))
        if None in ids:
            ids = [self._learn(piece) if one is None else one for piece, one in zip(pieces, ids)]
        return b"".join(ids)


def _after(state: int, byte: int) -> int:
    """UTF-8 by ranges.  0: between characters; 1 to 3: so many bytes follow; 4 to 7: the same after
    E0, ED, F0 and F4, whose next byte has a narrower range; -1: not UTF-8."""
    if state == 0:
        leads = [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xED, 0xED, 5), (0xE1, 0xEF, 2),
                 (0xF0, 0xF0, 6), (0xF4, 0xF4, 7), (0xF1, 0xF3, 3)]
        return next((after for low, high, after in leads if low <= byte <= high), -1)
    low, high, after = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1),
                        5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}[state]
    return after if low <= byte <= high else -1


AFTER = [[_after(state, byte) for byte in range(256)] for state in range(8)]


class StreamDecoder:
    """Text of ids that arrive in slices; what is given out ends between two characters."""

    def __init__(self, table: list[bytes], closed: np.ndarray):
        self.table, self.closed = table, closed
        self.state, self.open = 0, b""

    @staticmethod
    def table_of(ranks: dict[bytes, int]) -> tuple[list[bytes], np.ndarray]:
        """Bytes by id, and whether they begin and end between characters."""
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        closed = np.zeros(len(table), bool)
        for rank, token in enumerate(table):
            state = 0
            for byte in token:
                state = AFTER[state][byte]
                if state < 0:
                    break
            closed[rank] = state == 0
        return table, closed

    def feed(self, ids: np.ndarray) -> str:
        out: list[bytes] = []
        table, at = self.table, 0
        odd = np.flatnonzero(~self.closed[ids]).tolist()
        for stop in [*odd, len(ids)]:
            while at < stop and self.state:
                self._bytes(table[ids[at]], out)
                at += 1
            if at < stop:
                out.extend([table[one] for one in ids[at:stop].tolist()])
                at = stop
            if at == stop < len(ids):
                self._bytes(table[ids[at]], out)
                at += 1
        return b"".join(out).decode()

    def _bytes(self, data: bytes, out: list[bytes]) -> None:
        for byte in data:
            after = AFTER[self.state][byte]
            if after < 0 and self.state:
                out.append(REPLACEMENT)
                self.open, after = b"", AFTER[0][byte]
            if after < 0:
                out.append(REPLACEMENT)
                after = 0
            else:
                self.open += bytes([byte])
                if after == 0:
                    out.append(self.open)
            if after == 0:
                self.open = b""
            self.state = after

    def finish(self) -> str:
        """What is left: a replacement for a character that never ended."""
        left = REPLACEMENT.decode() if self.open else ""
        self.state, self.open = 0, b""
        return left


REPLACEMENT = "�".encode()


def _once(kind: str, *arguments):
    """One encoder or decoding table per worker process."""
    key = (kind, *arguments)
    if key not in _STATE:
        _STATE[key] = Encoder(*arguments) if kind == "encoder" else StreamDecoder.table_of(load_ranks(*arguments))
    return _STATE[key]


def _runs(sizes: Iterable[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``limit`` by their sizes."""
    first, total, at = 0, 0, 0
    for at, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield first, at
            first, total = at, 0
    if first < at:
        yield first, at


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each row's text, by the rank file ``ranks``; ``pattern`` cuts the pieces.

    ``ranks`` is a path that all executors have.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_search():
            yield from encoded_rows(batches)

    def encoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once("encoder", ranks, pattern)
        for batch in batches:
            texts = batch.column("text")
            for first, last in _runs(pa.compute.binary_length(texts).to_pylist()):
                ids = [encoder.encode(text) for text in texts.slice(first, last - first).to_pylist()]
                offsets = np.cumsum([0, *(len(one) // 4 for one in ids)]).astype(np.int32)
                values = np.frombuffer(b"".join(ids), "<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), lists], names=["doc_id", "ids"]
                )

    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(encoded, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, slice_ids: int = 4096) -> DataFrame:
    """Adds ``text`` to a table with a column ``ids``, read in slices of ``slice_ids``.

    Null ids give an empty text.  Other columns pass through; one named ``text`` is replaced.
    """
    others = [name for name in encoded.columns if name != "text"]
    schema = encoded.select(*others, F.lit("").alias("text")).schema

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, closed = _once("decoder", ranks)
        for batch in batches:
            lists = batch.column("ids")
            counts = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            for first, last in _runs((counts * 4).tolist()):
                part = lists.slice(first, last - first)
                values = part.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts[first:last])
                texts = []
                for end, count in zip(ends.tolist(), counts[first:last].tolist()):
                    stream = StreamDecoder(table, closed)
                    pieces = [
                        stream.feed(values[at : min(at + slice_ids, end)]) for at in range(end - count, end, slice_ids)
                    ]
                    texts.append("".join([*pieces, stream.finish()]))
                kept = [batch.column(name).slice(first, last - first) for name in others]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*others, "text"])

    return encoded.select(*others).mapInArrow(decoded, schema)
