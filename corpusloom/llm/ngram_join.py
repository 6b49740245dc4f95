"""Operator 6: Jaccard join of word n-gram sets by a prefix tree.

Texts whose sets are equal are one class.  Let ``t(n)`` be how many elements a set of ``n`` may
miss of a partner's.  Candidates are found in three exact steps:

1. All sets are ordered by hash and cut to their first ``2 t + 1`` elements.  Linked sets share
   at least ``t + 1`` of those, so a set with fewer elements that another set has too is out.  Most
   texts that only quote a common passage go here.
2. The cut sets of what is left are put in order of frequency, rarest first.  Linked sets share an
   element even without the last ``t`` of their common ones, so very frequent elements drop out.
3. Sets that share an element still form a group; a link never leaves its group.

Groups are cut by size class (linked sets differ by one class at most) and, where many, into
blocks by a hash; pairs of blocks are joined with the whole sets.  Within a block the sets are put
in one order, most frequent first, and stored in a trie whose nodes hold runs of elements.  Each
set walks the trie, sharing its overlap with all sets below a node, and turns back where the
elements that remain, of its own or below, cannot reach the similarity, or where all sets below
are already in its component.  First the blocks are joined with themselves and their like; only if
there are more, the other pairs follow, without those that are one component already.

Elements are 64-bit hashes of shingles; classes are told apart by 128 bits.  A null text, or one
without words, has the empty set and links with nothing, as does a row without id.  Repeated rows
are copies of each other.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import (
    BROADCAST_IDS,
    bounded,
    byte_slices,
    fresh,
    group_starts,
    join_parallelism,
    returning,
    spanning,
    stored,
    texts_of,
    whole_groups,
    without,
)
from corpusloom.llm.graph import components
from corpusloom.llm.hashing import fingerprint, shingle_sets

WIDTH = 3
OVER, OF = 90, 100
# Elements, and sets, per block.
BLOCK_ELEMENTS = 1_000_000
BLOCK_SETS = 2048


def _missing(n, over: int, of: int):
    """How many elements of a set of ``n`` a linked set may lack; for numbers and columns alike."""
    return n - (n * over + of - 1) // of


def sets_of(docs: DataFrame, width: int, over: int, of: int, whole: bool) -> DataFrame:
    """(doc_id, mark, n, lo, hi, elements) per row: all elements, or the first in hash order; the mark stands for the text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in byte_slices(texts_of(batch)):
                found = shingle_sets(data, offsets, width)
                marks = [fingerprint(one) for one in found]
                kept = found if whole else [one[: 2 * _missing(len(one), over, of) + 1] for one in found]
                ends = np.cumsum([0, *map(len, kept)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), batch.column("mark").slice(first, last - first),
                     pa.array([len(one) for one in found], pa.int64()),
                     pa.array([low for low, _ in marks], pa.int64()), pa.array([high for _, high in marks], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(kept)))],
                    names=["doc_id", "mark", "n", "lo", "hi", "elements"],
                )

    schema = "doc_id long, mark long, n long, lo long, hi long, elements array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text").mapInArrow(returning(made), schema)


def _groups(sets: DataFrame, reps: DataFrame, over: int, of: int) -> DataFrame:
    """(node, rep, n, group) of the sets that may have links, after the three steps above."""
    partner = F.ceil(F.col("n") * over / of)  # size of the smallest linked set
    missing = F.col("n") - partner
    must = partner - F.ceil(partner * over / of) + 1
    # A short set may miss nothing of a partner's and still lie within a larger one.
    linkable = (missing > 0) | (F.floor(F.col("n") * of / over) > F.col("n"))
    # Copies have one node, so an element is alone if all its rows are of one node.
    elements = sets.where(linkable).select("node", F.explode("elements").alias("element"))
    alone = elements.groupBy("element").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    alone = alone.groupBy("node").agg(F.count("*").alias("alone"))
    cut = F.least(F.col("n"), 2 * missing + 1)
    left = reps.where(linkable).join(alone, "node", "left").where(cut - F.coalesce("alone", F.lit(0)) >= must)
    left = stored(left.select("node", "rep", "n", must.alias("must")), "candidates")
    picked = F.broadcast(left) if bounded(left, BROADCAST_IDS) else left
    # One row of each class brings its elements; repeated rows only lengthen its list.
    rows = sets.select("node", "doc_id", "elements").join(picked, "node").where("doc_id = rep")
    elements = rows.select("node", "must", F.explode("elements").alias("element"))
    common = elements.groupBy("element").agg(F.count("*").alias("df")).where("df > 1")
    mine = Window.partitionBy("node")
    ranked = elements.join(common, "element").select(
        "node", "must", "element",
        F.row_number().over(mine.orderBy("df", "element")).alias("place"), F.count("*").over(mine).alias("shared"),
    )
    kept = stored(ranked.where("place <= shared - must + 1").select("node", "element"), "elements")
    least = kept.groupBy("element").agg(F.min("node").alias("b"), F.count("*").alias("df")).where("df > 1")
    found = components(kept.join(least, "element").select(F.col("node").alias("a"), "b"))
    return found.join(left.select("node", "rep", "n"), "node").withColumnRenamed("component", "group")


class Trie:
    """Sets as ascending ranks, in nodes that hold runs of ranks.

    A node's children have higher numbers than the node.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sets, self.sizes = sets, sizes
        words = [one.astype(">u4").tobytes() for one in sets]
        self.order = sorted(range(len(sets)), key=words.__getitem__)
        self.shared = [0] * len(sets)
        for at in range(1, len(sets)):
            a, b = sets[self.order[at - 1]], sets[self.order[at]]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared[at] = int(differ[0]) if len(differ) else n
        self.runs: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.ending: list[list[int]] = []
        self.least: list[int] = []
        self.rest: list[int] = []
        self.latest: list[int] = []
        self.starts: list[int] = []
        waiting = [(0, len(sets), 0, self.starts)]
        while waiting:  # sorted sets from low to high agree on their first depth ranks
            low, high, depth, into = waiting.pop()
            cuts = [low, *[at for at in range(low + 1, high) if self.shared[at] <= depth], high]
            for first, last in zip(cuts[:-1], cuts[1:]):
                if first < last:
                    inner, end = self._node(first, last, depth)
                    into.append(len(self.runs) - 1)
                    if inner < last:
                        waiting.append((inner, last, end, self.children[-1]))

    def _node(self, low: int, high: int, depth: int) -> tuple[int, int]:
        """A node for sets that agree beyond ``depth``: the first that goes on below it, and its end."""
        chosen = [self.order[at] for at in range(low, high)]
        end = min([len(self.sets[chosen[0]]), *self.shared[low + 1 : high]])
        self.runs.append(self.sets[chosen[0]][depth:end])
        self.ending.append([one for one in chosen if len(self.sets[one]) == end])
        self.least.append(int(min(self.sizes[one] for one in chosen)))
        self.rest.append(max(len(self.sets[one]) for one in chosen) - end)
        self.latest.append(max(chosen))
        self.children.append([])
        return low + len(self.ending[-1]), end


def linked_sets(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, cross: bool, heads: list[int],
                over: int, of: int) -> list[tuple[int, int]]:
    """Links that join components, found by walking each set through the trie of the others.

    ``sets`` hold ascending ranks below the largest, ``sizes`` the sizes of the whole sets.  With
    ``cross`` only pairs of different sides count.  ``heads`` are components known before.
    """
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first_of: dict[int, int] = {}
    for at, head in enumerate(heads):
        parent[at] = first_of.setdefault(head, at)
    probes = [at for at in range(len(sets)) if not cross or side[at] == 0]
    stored_sets = [at for at in range(len(sets)) if not cross or side[at] == 1]
    trie = Trie([sets[at] for at in stored_sets], sizes[stored_sets])
    nodes = len(trie.runs)
    uniform = [-1] * nodes

    def refresh() -> None:
        """For each node, a set below it if all below are one component, else -1."""
        for at in range(nodes - 1, -1, -1):
            heads_below = {root(stored_sets[one]) for one in trie.ending[at]}
            for child in trie.children[at]:
                heads_below.add(root(uniform[child]) if uniform[child] >= 0 else -1)
            uniform[at] = heads_below.pop() if len(heads_below) == 1 else -1

    refresh()
    marked = np.zeros(max((int(one[-1]) for one in sets if len(one)), default=0) + 1, bool)
    made, since = [], 0
    for probe in probes:
        mine, size = sets[probe], int(sizes[probe])
        if not len(mine):
            continue
        marked[mine] = True
        walk = [(node, 0) for node in reversed(trie.starts)]
        while walk:
            node, overlap = walk.pop()
            if not cross and stored_sets[trie.latest[node]] <= probe:
                continue
            if uniform[node] >= 0 and root(uniform[node]) == root(probe):
                continue
            run = trie.runs[node]
            if len(run):
                need = over * (size + trie.least[node])
                ahead = len(mine) - int(np.searchsorted(mine, run[0]))
                if (over + of) * (overlap + min(ahead, len(run) + trie.rest[node])) < need:
                    continue
                overlap += int(marked[run].sum())
                ahead = len(mine) - int(np.searchsorted(mine, run[-1], side="right"))
                if trie.children[node] and (over + of) * (overlap + min(ahead, trie.rest[node])) < need:
                    walk_on = False
                else:
                    walk_on = True
            else:
                walk_on = True
            for one in trie.ending[node]:
                other = stored_sets[one]
                if (cross or other > probe) and root(other) != root(probe) \
                        and (over + of) * overlap >= over * (size + int(sizes[other])):
                    made.append((probe, other))
                    a, b = root(probe), root(other)
                    parent[max(a, b)] = min(a, b)
                    since += 1
            if walk_on:
                walk += [(child, overlap) for child in reversed(trie.children[node])]
        marked[mine] = False
        if since >= 16:
            refresh()
            since = 0
    return made


def _ranks(elements: np.ndarray, owner: np.ndarray, count: int) -> list[np.ndarray]:
    """Sets of one block as ascending ranks, the most frequent element first, without those of one set."""
    values, place, times = np.unique(elements, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -times))] = np.arange(len(values))
    common = times[place] > 1
    ranks, owner = rank[place[common]], owner[common]
    order = np.lexsort((ranks, owner))
    return np.split(ranks[order], np.searchsorted(owner[order], np.arange(1, count)))


_PAIR = ["group", "low_class", "low_part", "high_class", "high_part"]


def _joined_blocks(members: DataFrame, pairs: DataFrame, sets: DataFrame, over: int, of: int) -> DataFrame:
    """Links (a, b) of the block pairs; ``members`` have node, group, class, part and head."""
    low = members.join(
        pairs.select("group", F.col("low_class").alias("class"), F.col("low_part").alias("part"), "high_class", "high_part"),
        ["group", "class", "part"],
    ).select("node", "head", "group", F.col("class").alias("low_class"), F.col("part").alias("low_part"),
             "high_class", "high_part", F.lit(0).alias("side"))
    apart = pairs.where("low_class != high_class OR low_part != high_part")
    high = members.join(
        apart.select("group", F.col("high_class").alias("class"), F.col("high_part").alias("part"), "low_class", "low_part"),
        ["group", "class", "part"],
    ).select("node", "head", "group", "low_class", "low_part",
             F.col("class").alias("high_class"), F.col("part").alias("high_part"), F.lit(1).alias("side"))
    rows = low.unionByName(high)
    if bounded(rows, 2 * BROADCAST_IDS):
        rows = F.broadcast(rows)
    rows = sets.join(rows, "node")
    rows = rows.repartition(join_parallelism(rows.sparkSession), *_PAIR).sortWithinPartitions(*_PAIR, "node")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, _PAIR):
            column = {name: group.column(name).to_numpy() for name in ("node", "head", "side", "n", *_PAIR)}
            lists = group.column("elements").combine_chunks()
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy()
            starts = group_starts(group, _PAIR)
            kept = []
            for first, last in zip(starts, [*starts[1:], group.num_rows]):
                elements = values[ends[first] : ends[last]]
                owner = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))
                ranks = _ranks(elements, owner, last - first)
                cross = bool(column["low_class"][first] != column["high_class"][first]
                             or column["low_part"][first] != column["high_part"][first])
                node = column["node"][first:last]
                kept += [(int(node[a]), int(node[b])) for a, b in linked_sets(
                    ranks, column["n"][first:last], column["side"][first:last], cross,
                    column["head"][first:last].tolist(), over, of)]
            kept = spanning(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in kept], pa.int64()), pa.array([b for _, b in kept], pa.int64())], names=["a", "b"]
            )

    return rows.mapInArrow(joined, "a long, b long")


def _in_blocks(members: DataFrame, block_elements: int, block_sets: int) -> tuple[DataFrame, DataFrame]:
    """Members with their block, and the blocks; what is one component for sure has blocks of its own."""
    key = ["group", "class", "known"]
    sized = members.groupBy(*key).agg(
        F.greatest(F.ceil(F.sum("n") / block_elements), F.ceil(F.count("*") / block_sets)).cast("int").alias("parts")
    )
    # Parts of the known component come first, those of the others behind them.
    before = sized.groupBy("group", "class").agg(F.sum(F.when(F.col("known"), F.col("parts")).otherwise(0)).alias("before"))
    sized = sized.join(before, ["group", "class"])
    offset = F.when(F.col("known"), 0).otherwise(F.col("before"))
    part = (F.pmod(F.xxhash64("node"), F.col("parts")) + offset).cast("int")
    laid = members.join(sized, key).withColumn("part", part)
    blocks = laid.groupBy("group", "class", "part").agg(F.min("head").alias("least"), F.max("head").alias("most"))
    return laid.select("node", "head", "group", "class", "part"), blocks


def _pairs_of(blocks: DataFrame) -> DataFrame:
    low = blocks.select("group", F.col("class").alias("low_class"), F.col("part").alias("low_part"),
                        F.col("least").alias("low_least"), F.col("most").alias("low_most"),
                        F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("high_class"))
    high = blocks.select("group", F.col("class").alias("high_class"), F.col("part").alias("high_part"),
                         F.col("least").alias("high_least"), F.col("most").alias("high_most"))
    pairs = low.join(high, ["group", "high_class"])
    return pairs.where("low_class != high_class OR low_part <= high_part")


def jaccard_classes(docs: DataFrame, width: int = WIDTH, over: int = OVER, of: int = OF,
                    block_elements: int = BLOCK_ELEMENTS, block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id; linked if |A∩B| * of >= |A∪B| * over."""
    return _classes(docs, width, over, of, block_elements, block_sets).drop("mark")


def _classes(docs: DataFrame, width: int, over: int, of: int, block_elements: int, block_sets: int) -> DataFrame:
    """``jaccard_classes`` with the hash of each text as ``mark``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored(sets_of(docs, width, over, of, False), "sets")
    usable = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    usable = usable.withColumn("node", F.xxhash64("lo", "hi", "n"))
    reps = usable.groupBy("lo", "hi", "n", "node").agg(F.min("doc_id").alias("rep"))
    reps = stored(reps.select("node", "n", "rep"), "classes")
    found = _groups(usable, reps, over, of)
    step = math.log(of / over) + 1e-6
    members = stored(found.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / step).cast("int")), "members")
    whole = stored(_whole_sets(docs, members, width, over, of), "whole")
    first, blocks = _in_blocks(members.withColumn("head", F.col("node")).withColumn("known", F.lit(False)),
                               block_elements, block_sets)
    blocks = stored(blocks, "blocks")
    pairs = _pairs_of(blocks)
    like = "(low_class = high_class AND low_part = high_part) OR (low_class != high_class AND low_part = high_part)"
    links = stored(_joined_blocks(first, pairs.where(like), whole, over, of), "links")
    wide = blocks.where("part > 0").select("group").distinct()
    if wide.limit(1).count():
        more = _rest(members.join(wide, "group", "left_semi"), links, whole, over, of, block_elements, block_sets)
        links = links.unionByName(stored(more, "links"))
    joined = components(links)
    named = joined.join(reps.select("node", "rep"), "node")
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = reps.select("node", "rep").join(joined, "node", "left").join(names, "component", "left").select(
        "node", F.coalesce("component_id", "rep").alias("component_id")
    )
    done = sets.select("doc_id", "mark", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(),
                                             F.xxhash64("lo", "hi", "n")).alias("node"))
    done = done.join(of_class, "node", "left")
    return done.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_class(docs: DataFrame, width: int = WIDTH, over: int = OVER, of: int = OF) -> DataFrame:
    """``docs`` with the row of the smallest id of each component only.

    Rows without id stay.  Of rows with equal id and text one stays; those of equal id and another
    text are judged by their own text.
    """
    classes = _classes(docs, width, over, of, BLOCK_ELEMENTS, BLOCK_SETS)
    kept = without(docs, classes.where("doc_id != component_id")).select(*docs.columns)
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if not repeated.limit(1).count():
        return kept
    # Repeats are told by id and a digest of the text, one row of each; rows without id are left alone.
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    name = fresh("_digest", docs)
    single = kept.where("doc_id IS NOT NULL").withColumn(name, digest).dropDuplicates(["doc_id", name])
    return single.drop(name).unionByName(kept.where("doc_id IS NULL"))


def _whole_sets(docs: DataFrame, members: DataFrame, width: int, over: int, of: int) -> DataFrame:
    """(node, n, elements) of the members, from their texts."""
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    if bounded(members, BROADCAST_IDS):
        ids = F.broadcast(ids)
    made = sets_of(docs.join(ids, "doc_id", "left_semi"), width, over, of, True)
    made = made.select(F.xxhash64("lo", "hi", "n").alias("node"), "n", "elements")
    nodes = members.select("node")
    return made.join(F.broadcast(nodes) if bounded(nodes, BROADCAST_IDS) else nodes, "node", "left_semi")


def _rest(members: DataFrame, links: DataFrame, whole: DataFrame, over: int, of: int,
          block_elements: int, block_sets: int) -> DataFrame:
    """Links of the other pairs of blocks of the groups that have many.

    The first links have made most of such a group one component.

    The largest component of a group and size class has blocks of its own, which need not meet each
    other; all other blocks meet all.
    """
    members = stored(members, "wide")
    mine = links.join(members.select(F.col("node").alias("a")), "a", "left_semi")
    heads = components(mine).select("node", F.col("component").alias("head"))
    members = members.join(heads, "node", "left").withColumn("head", F.coalesce("head", "node"))
    sizes = members.groupBy("group", "class", "head").agg(F.count("*").alias("size"))
    main = sizes.groupBy("group", "class").agg(F.max_by("head", F.struct("size", "head")).alias("main"))
    members = members.join(main, ["group", "class"]).withColumn("known", F.col("head") == F.col("main")).drop("main")
    laid, blocks = _in_blocks(stored(members, "members"), block_elements, block_sets)
    pairs = _pairs_of(stored(blocks, "blocks"))
    one = "low_least = low_most AND high_least = high_most AND low_least = high_least"
    return _joined_blocks(laid, pairs.where(f"NOT ({one})"), whole, over, of)
