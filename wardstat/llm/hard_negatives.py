"""Hard negatives by inner product, through R-trees packed by sort-tile-recursive.

Rows are dealt over tiles: by label, by slices of the coordinate that varies most, within each by slices of the next one,
and on. Each run of rows in that order is a block with a tree of its own, packed the same way: leaves of one label with
their minimum bounding boxes, boxes of boxes above. A box gives an interval for the inner product with an anchor. A
search takes boxes from a queue, those with the greatest upper bound first, and leaves out boxes whose interval misses the
window of wanted scores, whose label does not fit, or whose upper bound is strictly below the k-th score found so far. The
anchors of one group share a queue. All blocks meet all groups of anchors; what the blocks found is merged.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.llm.common import Shared, stored

#: Rows of a tree, of a leaf, and boxes in a box.
BLOCK, LEAF, FANOUT = 4096, 128, 8
#: Rows, chosen by key, that fix the cuts between tiles, and slices per coordinate at most. Every row is indexed.
SAMPLE_ROWS, SLICES = 20_000, 32
#: Anchors that search a tree together, about.
GROUP = 1024
#: Components beyond this count as this, so that inner products of 256 of them fit into 64 bits.
LARGEST = 1 << 27
#: Coordinates that a tree's rows are sorted by.
SORTED = 3


class Tree(NamedTuple):
    """Rows in leaf order, where leaves begin, and per level from the leaves up: low and high corners, least and greatest label."""

    ids: np.ndarray
    rows: np.ndarray
    begins: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _narrow(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.int16 if most < 1 << 15 else np.int32)


def _tiles(rows: np.ndarray, members: np.ndarray, coordinates: list[int]) -> Iterator[np.ndarray]:
    pages = -(-len(members) // LEAF)
    if pages > 1 and coordinates:
        members = members[np.argsort(rows[members, coordinates[0]], kind="stable")]
        slices = int(np.ceil(pages ** (1 / len(coordinates))))
        size = LEAF * -(-pages // slices)
        for start in range(0, len(members), size):
            yield from _tiles(rows, members[start : start + size], coordinates[1:])
    else:
        yield members


def pack(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Tree:
    leaves = []
    for label in np.unique(labels):
        members = np.flatnonzero(labels == label)
        spread = np.argsort(-rows[members].astype(np.float64).var(axis=0), kind="stable")[:SORTED]
        leaves += list(_tiles(rows, members, spread.tolist()))
    order = np.concatenate(leaves)
    begins = np.concatenate([[0], np.cumsum([len(leaf) for leaf in leaves])])
    ids, labels, rows = ids[order], labels[order], rows[order]
    boxes = (rows, rows, labels, labels)
    heads = begins[:-1]
    levels = []
    while True:
        boxes = tuple(f.reduceat(x, heads, axis=0) for f, x in zip((np.minimum, np.maximum) * 2, boxes))
        levels.append(boxes)
        if len(heads) == 1:
            return Tree(ids, rows, begins, levels)
        heads = np.arange(0, len(heads), FANOUT)


class Anchors(NamedTuple):
    """A group of anchors, and what is searched for: of which anchor, and the window of scores (inclusive)."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _product_type(a: np.ndarray, b: np.ndarray):
    """The quickest type in which inner products of whole numbers are exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def search(tree: Tree, anchors: Anchors, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(search, id, score): the k best rows of each search in the tree, of the anchor's label or of another one.

    Greater scores come first, smaller ids among equal ones. Rows of the anchor's own id don't count.
    """
    kind = _product_type(anchors.rows, tree.rows)
    own = anchors.rows.astype(kind)
    above, below = np.maximum(own, 0), np.minimum(own, 0)
    best = np.full(len(anchors.owner), np.iinfo(np.int64).min)
    found = (np.zeros(0, np.int64),) * 3
    turn = 0
    top = len(tree.levels) - 1
    queue = [(0.0, turn, top, 0, np.arange(len(anchors.owner)), np.full(len(anchors.owner), np.iinfo(np.int64).max))]
    while queue:
        _, _, level, node, asked, upper = heapq.heappop(queue)
        asked = asked[upper >= best[asked]]
        if not len(asked):
            continue
        who, place = np.unique(anchors.owner[asked], return_inverse=True)
        if level == 0 and node < 0:
            leaf = slice(tree.begins[~node], tree.begins[~node + 1])
            scores = (own[who] @ tree.rows[leaf].astype(kind).T).astype(np.int64)[place]
            fit = (scores >= np.maximum(anchors.low, best)[asked][:, None]) & (scores <= anchors.high[asked][:, None])
            fit &= anchors.ids[anchors.owner[asked]][:, None] != tree.ids[leaf][None, :]
            i, j = np.nonzero(fit)
            if len(i):
                found = tuple(np.concatenate(x) for x in zip(found, (asked[i], tree.ids[leaf][j], scores[i, j])))
                order = np.lexsort((found[1], -found[2], found[0]))
                found = tuple(x[order] for x in found)
                heads = np.flatnonzero(np.diff(found[0], prepend=-1))
                nth = np.arange(len(order)) - np.repeat(heads, np.diff(heads, append=len(order)))
                last = nth == k - 1
                best[found[0][last]] = found[2][last]
                found = tuple(x[nth < k] for x in found)
            continue
        low, high, least, most = tree.levels[level]
        inner = np.arange(node * FANOUT, min(len(low), (node + 1) * FANOUT)) if level < top else np.arange(len(low))
        lows, highs = low[inner].astype(kind), high[inner].astype(kind)
        uppers = (above[who] @ highs.T + below[who] @ lows.T).astype(np.int64)[place]
        lowers = (above[who] @ lows.T + below[who] @ highs.T).astype(np.int64)[place]
        label = anchors.labels[anchors.owner[asked]][:, None]
        fit = (label >= least[inner]) & (label <= most[inner])
        if not same:
            fit = ~((label == least[inner]) & (label == most[inner]))
        fit &= (uppers >= np.maximum(anchors.low, best)[asked][:, None]) & (lowers <= anchors.high[asked][:, None])
        for n, box in enumerate(inner.tolist()):
            rows = np.flatnonzero(fit[:, n])
            if len(rows):
                turn += 1
                first = -float(np.minimum(uppers[rows, n], anchors.high[asked[rows]]).max())
                heapq.heappush(queue, (first, turn, max(level - 1, 0), box if level else ~box, asked[rows], uppers[rows, n]))
    return found


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists as rows, the shorter ones filled with zeros."""
    values = lists.flatten().to_numpy()
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return np.clip(out, -LARGEST, LARGEST)


def _together(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns as the wider one."""
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def _cuts(rows: DataFrame, n: int, blocks: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The coordinates in order of their spread, and where slices of the first, and within these of the second, are cut."""
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vector").limit(2 * SAMPLE_ROWS)
    sample = _matrix(pa.array([r["vector"] for r in chosen.collect()], pa.list_(pa.int64())))
    slices = min(SLICES, int(np.ceil(blocks**0.5)))
    spread = np.argsort(-sample.astype(np.float64).var(axis=0), kind="stable").tolist() if len(sample) else []
    spread = (spread + [0, 0, 0])[:3]
    if not sample.size:
        return spread, np.zeros(0, np.int64), np.zeros((1, 0), np.int64)
    share = np.arange(1, slices) / slices
    first = np.quantile(sample[:, spread[0]], share, method="nearest")
    part = np.searchsorted(first, sample[:, spread[0]])
    second = [np.quantile(own if len(own) else sample[:, spread[1]], share, method="nearest") for own in (sample[part == s, spread[1]] for s in range(slices))]
    return spread, first, np.array(second).reshape(slices, -1)


def build(rows: DataFrame) -> DataFrame:
    """(tree): the blocks of ``rows`` (id, label, vector of whole numbers), each a packed tree of at most BLOCK rows."""
    n = rows.count()
    blocks = max(1, -(-n // BLOCK))
    cuts = Shared(rows.sparkSession, _cuts(rows, n, blocks))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread, first, second = cuts.load()
        for batch in batches:
            x = _matrix(batch.column("vector"))
            x = _together(x, np.zeros((0, max(spread) + 1), np.int64))[0]
            a = np.searchsorted(first, x[:, spread[0]])
            b = (second[a] < x[:, spread[1]][:, None]).sum(axis=1) if len(x) else a
            tile = pa.array(a * (second.shape[1] + 1) + b, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, tile, pa.array(x[:, spread[2]])], ["id", "label", "vector", "tile", "next"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tree() -> pa.RecordBatch:
            part = pa.concat_batches(held)
            vectors = _narrow(_matrix(part.column("vector")))
            packed = pack(part.column("id").to_numpy(), part.column("label").to_numpy(), vectors)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(packed))], pa.binary())], ["tree"])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - sum(b.num_rows for b in held))
                held.append(part)
                batch = batch.slice(part.num_rows)
                if sum(b.num_rows for b in held) == BLOCK:
                    yield tree()
                    held = []
        if held:
            yield tree()

    order = ["label", "tile", "next", "id"]
    dealt = rows.mapInArrow(deal, "id long, label long, vector array<long>, tile long, next long")
    dealt = stored(dealt, "vector-tiles")
    return stored(dealt.repartitionByRange(blocks, *order).sortWithinPartitions(*order).mapInArrow(grow, "tree binary"), "vector-trees")


def _grouped(asked: DataFrame, groups: int) -> DataFrame:
    """(group, anchors): rows (id, label, vector, low, high) packed by group; low and high are arrays, one entry per search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            numbers = batch.column("group").to_numpy()
            for g in np.unique(numbers).tolist():
                held.setdefault(g, []).append(batch.filter(pa.array(numbers == g)))
            while len(held) > 1:  # rows come sorted by group
                yield packed(next(iter(held)), held.pop(next(iter(held))))
        for g, parts in held.items():
            yield packed(g, parts)

    def packed(group: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.concat_batches(parts)
        size = np.diff(part.column("low").offsets.to_numpy())
        low, high = (part.column(c).flatten().to_numpy() for c in ("low", "high"))
        rows = _narrow(_matrix(part.column("vector")))
        value = (part.column("id").to_numpy(), part.column("label").to_numpy(), rows, np.repeat(np.arange(len(size)), size), low, high)
        return pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([pickle.dumps(value)], pa.binary())], ["group", "anchors"])

    rows = asked.select(F.pmod(F.xxhash64("id"), F.lit(groups)).alias("group"), "id", "label", "vector", "low", "high")
    rows = rows.repartition("group").sortWithinPartitions("group", "id")
    return stored(rows.mapInArrow(run, "group long, anchors binary"), "anchor-groups")


def _found(trees: DataFrame, asked: DataFrame, groups: int, k: int, same: bool) -> DataFrame:
    """(anchor, low, high, id, score): the best k rows of each block for each search of ``asked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, group in zip(batch.column("tree"), batch.column("anchors")):
                tree, anchors = Tree(*pickle.loads(tree.as_py())), Anchors(*pickle.loads(group.as_py()))
                width = max(tree.rows.shape[1], anchors.rows.shape[1])
                if tree.rows.shape[1] < width:
                    wide = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))  # noqa: B023, E731
                    tree = tree._replace(rows=wide(tree.rows), levels=[(wide(a), wide(b), c, d) for a, b, c, d in tree.levels])
                anchors = anchors._replace(rows=_together(anchors.rows, tree.rows)[0])
                at, ids, scores = search(tree, anchors, k, same)
                columns = [anchors.ids[anchors.owner[at]], anchors.low[at], anchors.high[at], ids, scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "low", "high", "id", "score"])

    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    met = trees.withColumn("group", numbers).join(_grouped(asked, groups), "group").select("tree", "anchors")
    return met.mapInArrow(run, "anchor long, low long, high long, id long, score long")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``rows`` (id, label, vector).

    ``vector`` is an array of whole numbers, the score of a row its inner product with the anchor. An anchor's positives
    are its first other rows of the same label; for each, the first rows of another label whose hundredfold score is from
    ``low`` to ``high`` times that of the positive are returned. Greater scores come first, smaller ids among equal ones.
    Rows with a null in any of the three take no part. Shorter vectors are filled with zeros; components beyond LARGEST count
    as LARGEST. A row that repeats counts each time, but an anchor's own id is none of its positives, and an anchor is
    one row: that of the smallest label and vector. An empty table, and anchors without positives, give no rows.
    """
    rows = rows.select("id", "label", "vector")
    rows = stored(rows.where("id is not null and label is not null and forall(vector, x -> x is not null)"), "vectors")
    whole = -(1 << 62), (1 << 62)
    first = F.min(F.struct(F.col("label"), F.col("vector"))).alias("x")
    anchors = rows.where(is_anchor).groupBy("id").agg(first).select("id", "x.label", "x.vector")
    anchors = stored(anchors, "anchors")
    groups = max(1, -(-anchors.count() // GROUP))
    trees = build(rows)

    asked = anchors.select("*", *[F.array(F.lit(v).cast("long")).alias(c) for c, v in zip(("low", "high"), whole)])
    near = _found(trees, asked, groups, positives, same=True).select("anchor", "id", "score")
    nth = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    near = stored(near.withColumn("nth", nth).where(F.col("nth") <= positives), "positives")

    # The least and the greatest whole score of each window. Positives of one score are searched for together.
    share = lambda percent: F.lit(float(percent)) * F.col("score") / 100
    near = near.withColumns({"low": F.ceil(share(low)), "high": F.floor(share(high))}).where("low <= high")
    windows = near.groupBy("anchor").agg(F.collect_set(F.struct("low", "high")).alias("w"))
    asked = anchors.join(windows, anchors["id"] == windows["anchor"]).select("id", "label", "vector", "w.low", "w.high")
    hard = _found(trees, asked, groups, negatives, same=False)
    nth = F.row_number().over(Window.partitionBy("anchor", "low", "high").orderBy(F.desc("score"), "id"))
    hard = hard.withColumn("rank", nth).where(F.col("rank") <= negatives).select("anchor", "low", "high", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(hard, ["anchor", "low", "high"]).select(
        F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )
