"""Operator 5: token ids of whole texts in Arrow files of equal-length sequences.

Documents are laid out in ascending id order, encoded, closed by an end id and packed one after
the other into sequences of a fixed length.  A shard is one file in the Arrow IPC file format:
record batches of ``BATCH_ROWS`` rows of two fixed-size lists, ``tokens`` (unsigned integers, two
bytes wide if the vocabulary fits) and ``mask`` (false behind the last token of the shard).  Row
``r`` is row ``r % BATCH_ROWS`` of batch ``r // BATCH_ROWS``, so with a memory map any sequence is
reached without copying or decoding.  ``index`` has one row per document: shard, first token
within the shard, number of tokens.

A shard is written by one task under a name of its attempt and then moved to its final name; a
task that is lost or runs twice leaves the same file.

A null text is empty and has the end id only.  Rows with equal ids follow in the order of their
text's checksum; rows without id come first.  An empty table gives no shard and an empty index.
Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import no_cycle_search, returning

LENGTH = 2048
BATCH_ROWS = 256
SHARD_BYTES = 32 << 20
INDEX = "shard int, doc_id long, shard_start long, n_tokens long"
# Encoded pieces a worker remembers of either generation; this changes no result.
REMEMBERED = 400_000

_STATE: dict = {}


_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"  # ASCII marks but the apostrophe, which may begin a contraction
# Pieces of texts of these with single spaces and line breaks; anything else is passed over.
_PIECES = re.compile(f" ?[{_LATIN}]+| ?[0-9]+| ?[{_MARKS}]+|\n(?=[{_LATIN}0-9{_MARKS}])")


class Encoder:
    """Encodes texts with a tokenizer file, each distinct word once.

    A byte-level pre-tokenizer cuts a text of Latin letters, digits, ASCII marks and single spaces
    or line breaks into runs of letters, of digits or of marks, each with the space before it, and
    line breaks.  In such texts each run is encoded once, many of them in one call of the library,
    and remembered.  Texts with anything else, apostrophes, longer white space or a special token
    are encoded whole, as are all texts under a tokenizer of another kind.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        before = plan["pre_tokenizer"] or {}
        special = "|".join(re.escape(token["content"]) for token in plan["added_tokens"])
        self.special = re.compile(special or "(?!)").search
        self.cuts = plan["normalizer"] is None and plan["post_processor"] is None and (
            before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        )
        if self.cuts:
            # An entry has one letter for each byte of its token.
            entries = plan["model"]["vocab"]
            self.sizes = np.zeros(max(entries.values()) + 1, np.int64)
            self.sizes[list(entries.values())] = list(map(len, entries))
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in encoded]

    def learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces, encoding runs that begin with a space side by side."""
        spaced = [piece for piece in pieces if piece[0] == " "]
        for first in range(0, len(spaced), 1000):
            some = spaced[first : first + 1000]
            encoded = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, "<u4")
            ends, reached = np.cumsum([len(piece.encode()) for piece in some]), np.cumsum(self.sizes[ids])
            at = np.minimum(np.searchsorted(reached, ends), len(ids) - 1) + 1
            if (reached[at - 1] == ends).all():
                data, stops = ids.tobytes(), [0, *(4 * at).tolist()]
                self.known.update(zip(some, [data[a:b] for a, b in zip(stops, stops[1:])]))
            else:
                self.known.update(zip(some, self.whole(some)))
        rest = [piece for piece in pieces if piece[0] != " "]
        self.known.update(zip(rest, self.whole(rest)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.remembered:
            self.old, self.known = self.known, {}
        found: list = [None] * len(texts)
        whole, cut, fresh = [], [], set()
        for at, text in enumerate(texts):
            pieces = _PIECES.findall(text) if self.cuts else []
            if len("".join(pieces)) < len(text) or self.special(text):
                whole.append(at)
                continue
            ids = list(map(self.known.get, pieces))
            found[at] = ids
            if None in ids:
                missing = [k for k, one in enumerate(ids) if one is None]
                fresh.update([pieces[k] for k in missing])
                cut.append((at, pieces, missing))
        for piece in [piece for piece in fresh if piece in self.old]:
            self.known[piece] = self.old[piece]
            fresh.discard(piece)
        self.learn(list(fresh))
        for at, pieces, missing in cut:
            for k in missing:
                found[at][k] = self.known[pieces[k]]
        found = [None if ids is None else b"".join(ids) for ids in found]
        for at, ids in zip(whole, self.whole([texts[at] for at in whole])):
            found[at] = ids
        return found


def _encoder(path: str, remembered: int) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    if (path, remembered) not in _STATE:
        _STATE.clear()
        _STATE[path, remembered] = Encoder(path, remembered)
    return _STATE[path, remembered]


def _layout(length: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("tokens", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Packs ids into sequences and writes full record batches."""

    def __init__(self, sink, length: int, wide: bool):
        self.schema, self.length = _layout(length, wide), length
        self.kind = np.uint32 if wide else np.uint16
        self.file = pa.ipc.new_file(sink, self.schema)
        self.rest: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: bytes) -> None:
        part = np.frombuffer(ids, "<u4").astype(self.kind)
        self.rest.append(part)
        self.waiting += len(part)
        if self.waiting >= 4 * BATCH_ROWS * self.length:
            self._write(False)

    def _write(self, last: bool) -> None:
        tokens = np.concatenate(self.rest) if self.rest else np.zeros(0, self.kind)
        step = BATCH_ROWS * self.length
        full = len(tokens) // step * step
        for at in range(0, full, step):
            self._batch(tokens[at : at + step], step)
        tokens = tokens[full:]
        if last and len(tokens):
            rows = -(-len(tokens) // self.length)
            padded = np.zeros(rows * self.length, self.kind)
            padded[: len(tokens)] = tokens
            self._batch(padded, len(tokens))
            tokens = tokens[:0]
        self.rest, self.waiting = [tokens], len(tokens)

    def _batch(self, tokens: np.ndarray, real: int) -> None:
        mask = np.arange(len(tokens)) < real
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(tokens), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        self._write(True)
        self.file.close()


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.arrow"


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder.removeprefix('file:'))}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
                 length: int = LENGTH, shard_bytes: int = SHARD_BYTES, remembered: int = REMEMBERED) -> DataFrame:
    """Encode ``docs`` into shards under ``folder``; the stored index, one row per document.

    ``tokenizer`` is the path of a tokenizer file that all executors have.  ``remembered`` trades
    the memory of a worker (some 200 bytes a piece, twice) for time and changes no result.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    laid = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.crc32("text"))
        .repartitionByRange(shards, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, encoder = task.partitionId(), _encoder(tokenizer, remembered)
        system, root = _file_system(folder)
        end = np.array([end_id], "<u4").tobytes()
        writer, start = None, 0
        own = f"{root}/_attempt-{task.taskAttemptId()}-{shard}"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(root, recursive=True)
                sink = system.open_output_stream(own)
                writer = ShardWriter(sink, length, encoder.wide)
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            starts, counts = [], []
            for first in range(0, len(ids), 500):
                for one in encoder.encode(texts.slice(first, 500).to_pylist()):
                    writer.add(one + end)
                    starts.append(start)
                    counts.append(len(one) // 4 + 1)
                    start += counts[-1]
            rows = [[shard] * len(ids), ids, starts, counts]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds)], names=["shard", "doc_id", "shard_start", "n_tokens"]
            )
        if writer is not None:
            writer.close()
            sink.close()
            system.move(own, shard_name(root, shard))

    index = f"{folder}/index"
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with no_cycle_search():
            yield from encoded(batches)

    laid.select("doc_id", "text").mapInArrow(returning(kept), INDEX).write.mode("overwrite").parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def with_start(index: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before it; the running sum is over shards only."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select(F.col("shard").alias("_shard"), F.coalesce(before, F.lit(0)).alias("_base"))
    joined = index.join(bases, F.col("shard") == F.col("_shard"))
    return joined.select(*index.columns, (F.col("_base") + F.col("shard_start")).alias("start"))


class Shard:
    """A shard opened for random access."""

    def __init__(self, folder: str, shard: int):
        system, root = _file_system(folder)
        name = shard_name(root, shard)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else system.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("tokens").type.list_size

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and mask of one sequence; the tokens are a view of the file."""
        batch = self.file.get_batch(row // BATCH_ROWS)
        at = row % BATCH_ROWS
        tokens = batch.column("tokens").slice(at, 1).flatten().to_numpy()
        mask = batch.column("mask").slice(at, 1).flatten().to_numpy(zero_copy_only=False)
        return tokens, mask

    def parts(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, by record batch."""
        step = BATCH_ROWS * self.length
        while count:
            at = start // step
            if getattr(self, "_at", None) != at:
                self._at, self._ids = at, self.file.get_batch(at).column("tokens").flatten().to_numpy()
            part = self._ids[start % step : start % step + count]
            yield part
            start, count = start + len(part), count - len(part)

    def close(self) -> None:
        self.source.close()


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, with the checksum of its ids as the files hold them."""
    index = with_start(spark.read.schema(INDEX).parquet(f"{folder}/index"))
    columns = ["shard", "doc_id", "shard_start", "n_tokens", "start"]

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "shard_start", "n_tokens")))
            sums = []
            for at, start, count in rows:
                if at != number:
                    if shard is not None:
                        shard.close()
                    shard, number = Shard(folder, at), at
                crc = 0
                for part in shard.parts(start, count):
                    crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(sums, pa.int64())], names=[*columns, "ids_crc32"]
            )

    laid = index.select(*columns).repartition("shard").sortWithinPartitions("shard", "shard_start")
    schema = "shard int, doc_id long, shard_start long, n_tokens long, start long, ids_crc32 long"
    return laid.mapInArrow(returning(checked), schema)
