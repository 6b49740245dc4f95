"""Lexicons and term lists of any size: which terms of a table occur in a text, anywhere in it.

A handful of keywords is a native chain of ``contains``; beyond some hundred terms each text
would be searched once per term.  Here the terms are cut by hash into blocks of bounded size, each
broadcast, and every task compiles a block once into an automaton that walks a text once for all its
terms.  A task holds one automaton at a time: of several blocks, its texts and their hits wait in
temporary files until the last block has been walked.  Occurrences may overlap and lie inside words, as with ``contains``.

Null and empty terms find nothing, repeated terms count once; a null text has no hits.  An empty
table of terms gives no hits.  Each further block is one more walk over the texts.
"""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.batches import slices
from corpusloom.session import materialize

# Bytes of terms in one block; an automaton takes about ten times as much.
BLOCK_BYTES = 16_000_000
# Bytes of texts whose hits are put together at once.
SLICE_BYTES = 1 << 20

HITS = "array<struct<term: string, n: bigint>>"


def term_blocks(terms: DataFrame, keep: list[str], block_bytes: int = BLOCK_BYTES) -> list[pa.Table]:
    """The rows of ``terms`` (``term`` and ``keep``) in blocks of about ``block_bytes`` by a hash of the term, each in order.

    The driver holds one block at a time and what the callers' broadcasts hold: terms, not texts.
    """
    rows = terms.select("term", *keep).where("term != ''").distinct()
    size = rows.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        rows = materialize(rows)
    cut = rows.withColumn("_block", F.pmod(F.xxhash64("term"), F.lit(blocks)))
    found = (cut.where(F.col("_block") == at).drop("_block").toArrow() for at in range(blocks))
    return [block.sort_by("term").combine_chunks() for block in found if block.num_rows]


def _automaton(terms: pa.ChunkedArray):
    """An automaton that finds the places of ``terms`` in their block."""
    import ahocorasick

    machine, at = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0
    for part in terms.chunks:
        for piece in slices(part, SLICE_BYTES):
            for at, term in enumerate(piece.to_pylist(), at):
                machine.add_word(term, at)
            at += 1
    machine.make_automaton()
    return machine


def _places(machine, text: str) -> np.ndarray:
    return np.fromiter((at for _, at in machine.iter(text)), np.int32)


Search = Callable[[pa.Array], pa.Array]


def _hits_in(block: pa.Table) -> Search:
    """The terms of a block in each text, each with its occurrences."""
    terms, machine = block.column("term"), _automaton(block.column("term"))

    def search(texts: pa.Array) -> pa.Array:
        found = [np.unique(_places(machine, t or ""), return_counts=True) for t in texts.to_pylist()]
        places = pa.array(np.concatenate([places for places, _ in found]))
        counts = pa.array(np.concatenate([counts for _, counts in found]).astype(np.int64))
        named = pa.StructArray.from_arrays([terms.take(places).combine_chunks(), counts], names=["term", "n"])
        ends = np.cumsum([0, *(len(places) for places, _ in found)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), named, mask=texts.is_null())

    return search


def _all_hits(parts: Sequence[pa.Array]) -> pa.Array:
    """Lists of the same texts from several blocks as one list a text."""
    sizes = [pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False) for part in parts]
    rows = np.concatenate([np.repeat(np.arange(len(size)), size) for size in sizes])
    values = pa.concat_arrays([part.flatten() for part in parts]).take(pa.array(np.argsort(rows, kind="stable")))
    ends = np.concatenate([[0], np.cumsum(np.sum(sizes, axis=0))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=parts[0].is_null())


def _lowest_in(block: pa.Table) -> Search:
    """The lowest tier among the terms of a block in each text."""
    machine, tiers = _automaton(block.column("term")), block.column("tier").to_numpy()

    def search(texts: pa.Array) -> pa.Array:
        found = (_places(machine, t or "") for t in texts.to_pylist())
        return pa.array([tiers[places].min().item() if len(places) else None for places in found], pa.int32())

    return search


def _lowest(parts: Sequence[pa.Array]) -> pa.Array:
    return pc.min_element_wise(*parts)


def _spooled(arrays: Iterable[pa.Array], file) -> Callable[[], Iterator[pa.Array]]:
    """Write arrays to ``file``; a function that reads them back from the first."""
    writer = None
    for one in arrays:
        batch = pa.record_batch([one], names=["value"])
        writer = writer or pa.ipc.new_stream(file, batch.schema)
        writer.write_batch(batch)
    if writer:
        writer.close()

    def read() -> Iterator[pa.Array]:
        file.seek(0)
        for batch in pa.ipc.open_stream(file) if writer else ():
            yield batch.column(0)

    return read


def _walk(context, blocks: Sequence[pa.Table], search_of: Callable[[pa.Table], Search], joined, kind: str):
    """Column function: what ``search_of`` finds in a text by each block, put together by ``joined``."""
    held = [context.broadcast(block) for block in blocks]

    @F.arrow_udf(kind)
    def walked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = (piece for batch in batches for piece in slices(batch, SLICE_BYTES))
        if len(held) == 1:
            yield from map(search_of(held[0].value), pieces)
            return
        with contextlib.ExitStack() as files:
            def spooled(arrays):
                return _spooled(arrays, files.enter_context(tempfile.TemporaryFile()))

            texts = spooled(pieces)
            parts = [spooled(map(search_of(block.value), texts())) for block in held]
            for same in zip(*(part() for part in parts)):
                yield joined(same)

    return walked


def term_hits(df: DataFrame, text: Column, terms: DataFrame, name: str = "hits", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``array<struct<term, n>>``: the terms that occur in the text and how often; null for a null text."""
    blocks = term_blocks(terms, [], block_bytes)
    if not blocks:
        none = F.array().cast(HITS)
        return df.withColumn(name, F.when(text.isNotNull(), none))
    return df.withColumn(name, _walk(df.sparkSession.sparkContext, blocks, _hits_in, _all_hits, HITS)(text))


def label_by_terms(
    df: DataFrame, text: Column, lexicon: DataFrame, default_level: str, default_confidence: float,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add ``urgency_level`` and ``confidence`` from a lexicon table (term, tier, level, confidence).

    The lowest tier with a term anywhere in the text decides, as with a ``Lexicon``; tiers are few,
    each with one level and confidence.  Terms and text are compared as they are: fold both.
    """
    lowest = lexicon.where(F.col("tier").isNotNull()).groupBy("term").agg(F.min("tier").alias("tier"))
    blocks = term_blocks(lowest, ["tier"], block_bytes)
    tier = F.lit(None).cast("int")
    if blocks:
        tier = _walk(df.sparkSession.sparkContext, blocks, _lowest_in, _lowest, "int")(text)
    tiers = lexicon.select("tier", "level", "confidence").distinct().sort("tier").collect()
    if len({r.tier for r in tiers}) < len(tiers):
        raise ValueError("a tier of the lexicon has several levels or confidences")
    rows = df.withColumn("_tier", tier)
    level, confidence = F.lit(default_level), F.lit(default_confidence)
    for r in tiers:
        level = F.when(F.col("_tier") == r.tier, r.level).otherwise(level)
        confidence = F.when(F.col("_tier") == r.tier, r.confidence).otherwise(confidence)
    return rows.withColumn("urgency_level", level).withColumn("confidence", confidence).drop("_tier")
