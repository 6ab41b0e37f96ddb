"""Boosted trees and forests from histograms, and how they score.

Training rows become blocks of bin numbers, held in memory on the executors. Every level of a tree is one pass: each
block sums what its rows bring per (node, input, bin), and the sums are added up. A forest's sums are added up and its
splits chosen on the executors; the driver gets a row per node. Boosted trees make thousands of short passes with small
sums, which the driver adds up: a pass reads only the rows that its round has drawn, counts inputs of few bins together,
and leaves out the larger child of each node, which has what its sibling lacks. Sums are of whole numbers, gradients
included, and draws come from a hash of the row's key, so a model depends on its rows and settings alone: not on
partitions, their order or retries.

Rows of one partition are summed with numpy in its task. Of more, the passes run in the executors' JVM, where the blocks
lie as they are, without a Python worker (``Passes.java``): each pass has both forms, and they give the same numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.java_gateway import JavaObject
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wardstat.operators.jvm import passes, sent, taken
from wardstat.session import use_checkpoints

# Code that runs in Python workers is shipped with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block at most, and rows of one that passes work on: its columns fit a core's cache.
BLOCK_ROWS, PASS_ROWS = 1 << 18, 1 << 15
#: Blocks are bytes already. Held as they are, a pass need not unpack and decode them first, as it would in Spark's usual level.
HELD = StorageLevel.MEMORY_AND_DISK_DESER
#: Rows for which a pass is worth a task: boosted trees make thousands of short passes, a forest some dozens of long ones.
BOOSTED_ROWS, FOREST_ROWS = 125_000, 10_000
#: Cells of inputs that are summed as one: the product of their bins.
BUNDLE_CELLS = 1024
#: Bytes of sums of all blocks that are added up on the driver; more are added up on the executors first.
SUMMED_BYTES = 64 << 20
#: Bytes of sums that a block makes at once; the nodes of a forest are summed in so many passes.
SUM_BYTES = 8 << 20
#: Rounds after which the margins are held anew; in between a round adds the trees since to those held, in the same order.
HELD_ROUNDS = 5
#: Rounds after which they are written to the shared folder and their lineage is cut.
CHECKPOINT_ROUNDS = 25
#: Levels of a tree whose ways down are looked up at once, by a bit per node.
LOOKED_UP = 4
#: Splits whose bits lie in one number.
MASK_BITS = 62
#: A split of boosted trees must gain more than this.
LEAST_GAIN = 1e-6

LEDGER = (
    "tree int, node int, feature string, threshold double, gain double, n_rows long, weight double, value double"
)


class Trees(NamedTuple):
    """Trees as arrays (tree, node); node i has the children 2i + 1, for values below the threshold, and 2i + 2.

    ``feature`` is the place of the input, -1 at a leaf and -2 where there is no node.
    """

    feature: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    n_rows: np.ndarray
    weight: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return int(self.feature.shape[1] + 1).bit_length() - 2


def no_trees(n: int, depth: int) -> Trees:
    shape = (n, 2 ** (depth + 1) - 1)
    floats = [np.zeros(shape) for _ in range(4)]
    return Trees(np.full(shape, -2, np.int16), floats[0], floats[1], np.zeros(shape, np.int64), *floats[2:])


class Block(NamedTuple):
    """Rows. For boosted trees their bins make way for ``codes`` (row, bundle), which say the same in less room."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    key: np.ndarray
    margin: np.ndarray
    codes: np.ndarray | None = None


class Drawn(NamedTuple):
    """The rows of a block that a round has drawn, with their first and second derivatives."""

    codes: np.ndarray
    g: np.ndarray
    h: np.ndarray


def _merged(blocks: Iterable[Block], size: int) -> Iterator[Block]:
    """The same rows in blocks of ``size``, but for the last one."""

    def whole() -> Block:
        parts = [np.concatenate(x) for x in zip(*(b[:5] for b in held))]
        return Block(np.asfortranarray(parts[0]), *parts[1:])

    held: list[Block] = []
    for block in blocks:
        start = 0
        while start < len(block.label):
            end = start + size - sum(len(b.label) for b in held)
            held.append(Block(*(x[start:end] for x in block[:5])))
            if end <= len(block.label):
                yield whole()
                held = []
            start = end
    if held:
        yield whole()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64 bits of each number."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(seed: int, number: int) -> np.ndarray:
    return _mixed(np.array([seed * 1_000_003 + number + 1], np.uint64))


def draws(key: np.ndarray, seed: int, number: int) -> np.ndarray:
    """An even number from 0 to below 1 for each key, another one for each ``number``."""
    return (_mixed(key ^ _salt(seed, number)) >> np.uint64(11)) * 2.0**-53


def chosen_inputs(seed: int, number: int, n: int, wanted: int) -> np.ndarray:
    """``wanted`` of ``n`` inputs, drawn without putting back; which ones depends on seed and number alone."""
    return np.sort(np.argsort(draws(np.arange(n, dtype=np.uint64), seed, number), kind="stable")[:wanted])


# Bins.


def bin_cuts(frame: DataFrame, inputs: Sequence[str], coarse: dict[str, int], max_bins: int) -> list[np.ndarray]:
    """Where the bins of each input begin, but for the first bin: at each of its values, or at quantiles if it is coarse."""
    fine = [name for name in inputs if name not in coarse]
    found: dict[str, np.ndarray] = {}
    if fine:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The values of a task's rows, each once: a row per value leaves it, and not one per row and input."""
            seen = [pa.array([], pa.float64())] * len(fine)
            for batch in batches:
                seen = [pc.unique(pa.concat_arrays([own, pc.unique(x).drop_null()])) for own, x in zip(seen, batch.columns)]
            places = np.repeat(np.arange(len(fine)), [len(own) for own in seen])
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.concat_arrays(seen)], ["place", "x"])

        values = frame.select(*[F.col(name).cast("double").alias(name) for name in fine])
        rows = values.mapInArrow(run, "place long, x double").distinct().collect()
        for i, name in enumerate(fine):
            found[name] = np.unique([r["x"] for r in rows if r["place"] == i])[1:]
    if coarse:
        shares = [i / max_bins for i in range(1, max_bins)]
        quantiles = [F.percentile_approx(F.col(name).cast("double"), shares, 100 * max_bins).alias(name) for name in coarse]
        row = frame.agg(*quantiles).first()
        found |= {name: np.unique(row[name]) for name in coarse}
    return [found[name] for name in inputs]


def _bins(batch: pa.RecordBatch, inputs: Sequence[str], cuts: list[np.ndarray]) -> np.ndarray:
    kind = np.uint8 if max((len(c) for c in cuts), default=0) < 256 else np.uint16
    out = np.empty((batch.num_rows, len(inputs)), kind)
    for i, (column, c) in enumerate(zip(_columns(batch, inputs), cuts)):
        x = column.to_numpy(zero_copy_only=False)
        if x.dtype.kind == "i" and len(x) and int(x.max()) - int(x.min()) < len(x):
            # Fewer whole numbers than rows: each is looked for once.
            low = x.min()
            out[:, i] = np.searchsorted(c, np.arange(low, int(x.max()) + 1), side="right").take(x - low)
        else:
            out[:, i] = np.searchsorted(c, column.cast(pa.float64()).to_numpy(), side="right")
    return out


def _columns(batch: pa.RecordBatch, inputs: Sequence[str]) -> list[pa.Array]:
    for name in inputs:
        if batch.column(name).null_count:
            raise ValueError(f"{name} is null in a row for a tree model")
    return [batch.column(name) for name in inputs]


def _values(batch: pa.RecordBatch, inputs: Sequence[str]) -> np.ndarray:
    return np.stack([column.cast(pa.float64()).to_numpy() for column in _columns(batch, inputs)], axis=1)


class Pass(NamedTuple):
    """What is done to blocks: in numpy, and the name and the numbers that the pass of the JVM gets."""

    run: Callable
    name: str
    sent: Callable[[], bytes]

    def __call__(self, *given):
        return self.run(*given)


def blocks(frame: DataFrame, inputs: Sequence[str], weight: str, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of the frame's rows (inputs, label, ``weight``, _key): their bins, row by row, and the others as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            bins, label, own, key = (np.concatenate(x) for x in zip(*held))
            whole = label.astype(np.int8)
            label = whole if np.array_equal(whole, label) else label
            columns = [pa.array([x.tobytes()], pa.binary()) for x in (bins, label, own, key)]
            return pa.RecordBatch.from_arrays([pa.array([bins.dtype == np.uint8]), *columns], ["small", "bins", "label", "weight", "key"])

        for batch in batches:
            key = batch.column("_key").to_numpy().view(np.uint64)
            label, own = (batch.column(c).cast(pa.float64()).to_numpy() for c in ("label", weight))
            held.append((_bins(batch, inputs, cuts), label, own, key))
            if sum(len(x[1]) for x in held) >= BLOCK_ROWS - len(key):
                yield block()
                held = []
        if held:
            yield block()

    packed = "small boolean, bins binary, label binary, weight binary, key binary"
    return frame.select(*inputs, "label", weight, "_key").mapInArrow(run, packed)


def _unpacked(small: bool, bins: bytes, label: bytes, weight: bytes, key: bytes) -> Block:
    own = np.frombuffer(weight)
    rows = np.frombuffer(bins, np.uint8 if small else np.uint16).reshape(len(own), -1)
    of = np.frombuffer(label, np.int8 if len(label) == len(own) else np.float64).astype(np.float64)
    return Block(np.asfortranarray(rows), of, own, np.frombuffer(key, np.uint64), np.zeros(len(own)))


class _Spread:
    """Blocks in the executors' JVM: a pass is a job, and what the blocks sum is added up."""

    def __init__(self, rows: RDD):
        self.rows = self.read = rows.persist(HELD)
        self.older: list[RDD] = []

    def made(self, done: Pass, *more) -> JavaObject:
        return passes(self.rows.ctx).make(done.name, done.sent() + sent(*more))

    def summed(self, sums: Pass, shape: tuple) -> np.ndarray:
        parts, add = self.read._jrdd.mapPartitions(self.made(sums)), self.made(ADD)
        few = self.rows.getNumPartitions() * 8 * np.prod(shape) <= SUMMED_BYTES
        found = parts.reduce(add) if few else parts.treeReduce(add, 3)
        self.forget()
        return np.frombuffer(taken(self.rows.ctx, found), np.int64).reshape(shape)

    def chosen(self, sums: Pass, shape: tuple, choose: Pass) -> Iterable[tuple]:
        """What ``choose`` makes of slices of the sums, each given with its first place: it runs where they are added up."""
        n, slices = shape[0], min(shape[0], max(1, self.rows.ctx.defaultParallelism))
        ends = [n * i // slices for i in range(slices + 1)]
        added = self.read._jrdd.mapPartitionsToPair(self.made(sums, ends)).reduceByKey(self.made(ADD), slices)
        found = np.frombuffer(taken(self.rows.ctx, added.map(self.made(choose, ends)).collect()), np.int64).reshape(-1, 13)
        x = found[np.argsort(found[:, 0])]
        y = x.view(np.float64)
        return [(x[:, 1], x[:, 2] > 0, y[:, 3], x[:, 4], y[:, 5:7], x[:, 7], y[:, 8:10], x[:, 10], y[:, 11:])]

    def forget(self) -> None:
        for rows in self.older:  # the job has made the newer blocks from them
            rows.unpersist()
        self.older = []

    def changed(self, change: Pass, cut_lineage: bool) -> None:
        self.older.append(self.rows)
        self.rows = self.mapped(change)
        if cut_lineage:
            self.rows.checkpoint()

    def drawn(self, draw: Pass) -> None:
        """What passes read from now on."""
        if self.read is not self.rows:
            self.older.append(self.read)
        self.read = self.mapped(draw)

    def mapped(self, done: Pass) -> RDD:
        return RDD(self.rows._jrdd.mapPartitions(self.made(done)), self.rows.ctx).persist(HELD)

    def release(self) -> None:
        for rows in (*self.older, self.read, self.rows):
            rows.unpersist()


#: Sums of two partitions as one.
ADD = Pass(np.add, "add", sent)


class _Here:
    """The blocks of one partition, in the task that has them."""

    def __init__(self, rows: list[Block]):
        self.rows = self.read = rows

    def summed(self, sums: Pass, shape: tuple) -> np.ndarray:
        return sums(self.read)

    def chosen(self, sums: Pass, shape: tuple, choose: Pass) -> Iterable[tuple]:
        return [choose(0, reduce(np.add, map(sums, self.read), np.zeros(shape, np.int64)))]

    def changed(self, change: Pass, cut_lineage: bool) -> None:
        self.rows = [change(block) for block in self.rows]

    def drawn(self, draw: Pass) -> None:
        self.read = [draw(block) for block in self.rows]


def _grown(rows: DataFrame, grow: Callable[[_Spread | _Here], Trees], most: int, size: int) -> Trees:
    """The trees that ``grow`` makes of blocks, in ``most`` partitions at most and no more than run at once. In one partition
    there is nothing to add up: it grows where the blocks are, of ``size`` rows, in one job instead of one for each pass. The
    trees are the same."""
    context, packed = rows.sparkSession.sparkContext, rows.rdd
    most = min(max(1, most), packed.getNumPartitions(), context.defaultParallelism)
    if most == 1:
        whole = packed.coalesce(1).mapPartitions(lambda own: [tuple(grow(_Here(list(_merged((_unpacked(*x) for x in own), size)))))])
        return Trees(*whole.collect()[0])
    read = passes(context).make("read", b"")
    held = _Spread(RDD(rows._jdf.toJavaRDD().map(read).coalesce(most), context))
    try:
        return grow(held)
    finally:
        held.release()


class Layout(NamedTuple):
    """Where the bins of each input lie in a row of sums, and the cuts between them."""

    cuts: list[np.ndarray]

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])

    @property
    def size(self) -> int:
        return int(self.first[-1])

    def prefix(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums up to each bin within its input, and of the whole input, along the last axis but one."""
        first = self.first
        upto = np.cumsum(sums, axis=-2)
        before = np.zeros_like(upto)
        for a, b in zip(first[:-1], first[1:]):
            if a:
                before[..., a:b, :] = upto[..., a - 1 : a, :]
        upto = upto - before
        whole = np.zeros_like(upto)
        for a, b in zip(first[:-1], first[1:]):
            whole[..., a:b, :] = upto[..., b - 1 : b, :]
        return upto, whole

    def split_places(self) -> np.ndarray:
        """True where a bin can be the last one on the left: not at the last bin of an input."""
        out = np.ones(self.size, bool)
        out[self.first[1:] - 1] = False
        return out

    def at(self, place: int) -> tuple[int, int, float]:
        """Input, bin and threshold of a split place."""
        feature = int(np.searchsorted(self.first, place, side="right") - 1)
        own = int(place - self.first[feature])
        return feature, own, float(self.cuts[feature][own])


def _best(gain: np.ndarray) -> np.ndarray:
    """Place of the greatest gain of each node, the first of equal ones; gains that differ by rounding alone are equal."""
    top = gain.max(axis=1, keepdims=True)
    return (gain >= top - 1e-9 * np.abs(top)).argmax(axis=1)


def _stepped(bins: np.ndarray, rows: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The nodes of ``rows`` one step further down a tree that grows, by bin numbers; a row in a leaf stays there."""
    split = feature >= 0
    start = np.where(split, feature, 0).astype(np.int64) * len(bins)
    highest = np.where(split, cut, np.iinfo(bins.dtype).max).astype(bins.dtype)
    child = np.where(split, 2 * np.arange(len(split)) + 1, np.arange(len(split)))
    at = start.take(node)
    at += rows
    out = child.take(node)
    out += bins.T.ravel().take(at) > highest.take(node)
    return out


class Bundle(NamedTuple):
    """Inputs summed as one: a row's code is the place of its bins among all combinations. ``marks`` (code, bin of an
    input) adds the sums per code up to sums per bin, which lie at ``places`` of a row of sums."""

    inputs: list[int]
    steps: list[int]
    marks: np.ndarray
    places: np.ndarray


def bundles(layout: Layout) -> list[Bundle]:
    """All inputs, those with few bins together. A pass then counts each row once per bundle and not once per input."""
    bins = [len(c) + 1 for c in layout.cuts]
    groups: list[list[int]] = []
    size = 0
    for f in sorted(range(len(bins)), key=lambda f: bins[f]):
        if groups and size * bins[f] <= BUNDLE_CELLS:
            groups[-1].append(f)
            size *= bins[f]
        else:
            groups.append([f])
            size = bins[f]
    out = []
    for own in groups:
        cells = int(np.prod([bins[f] for f in own]))
        steps = [int(np.prod([bins[f] for f in own[:i]], dtype=np.int64)) for i in range(len(own))]
        digit = [np.arange(cells) // step % bins[f] for f, step in zip(own, steps)]
        marks = np.concatenate([d[:, None] == np.arange(bins[f]) for f, d in zip(own, digit)], axis=1)
        places = np.concatenate([layout.first[f] + np.arange(bins[f]) for f in own])
        out.append(Bundle(own, steps, marks, places))
    return out


def _numbers(packs: list[Bundle]) -> tuple[Sequence[int], ...]:
    """Per input its bundle, its step in the bundle's codes, its bins and the first one's place; then the codes of each bundle."""
    out = np.zeros((4, sum(len(b.inputs) for b in packs)), np.int64)
    for i, b in enumerate(packs):
        bins = np.array([*b.steps[1:], len(b.marks)]) // b.steps
        out[:, b.inputs] = [np.full(len(bins), i), b.steps, bins, b.places[np.cumsum(bins) - bins]]
    return *out, [len(b.marks) for b in packs]


# Boosted trees.


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 400
    depth: int = 5
    step: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    penalty: float = 1.0
    least_child: float = 1.0
    seed: int = 42


def exp(x: np.ndarray) -> np.ndarray:
    """The exponential, by steps that every machine rounds alike: numpy's and the JVM's own differ in the last bit."""
    x = np.clip(x, -700.0, 700.0)
    k = np.floor(x * 1.44269504088896338700e00 + 0.5)
    hi, lo = x - k * 6.93147180369123816490e-01, k * 1.90821492927058770002e-10
    r = hi - lo
    t = r * r
    c = r - t * (
        1.66666666666666019037e-01
        + t * (-2.77777777770155933842e-03 + t * (6.61375632143793436117e-05 + t * (-1.65339022054652515390e-06 + t * 4.13813679705723846039e-08)))
    )
    return np.ldexp(1.0 - ((lo - (r * c) / (2.0 - c)) - hi), k.astype(np.int64))


def gradients(label: np.ndarray, weight: np.ndarray, margin: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted log loss by the margin, as whole multiples of 2**-bits."""
    p = 1.0 / (1.0 + exp(-margin))
    return np.rint(weight * (p - label) * 2.0**bits), np.rint(np.maximum(weight * p * (1 - p), 1e-16) * 2.0**bits)


def fixed_bits(total_weight: float, most_weight: float) -> int:
    """Binary places of gradients such that sums of a block are exact in a double, and all sums in 64 bits."""
    block = 52 - int(np.ceil(np.log2(max(most_weight, 1.0) * BLOCK_ROWS)))
    return max(0, min(block, 61 - int(np.ceil(np.log2(max(total_weight, 1.0))))))


def boost(frame: DataFrame, inputs: Sequence[str], weight: str, cuts: list[np.ndarray], settings: BoostSettings = BoostSettings()) -> Trees:
    """Second-order boosted trees on the log loss.

    Each round draws rows and inputs, grows one tree level by level and adds ``step`` times its leaves to the margins.
    A leaf is -G / (H + penalty) of the sums of first and second derivatives; a split gains what the squares
    G * G / (H + penalty) of its sides have over that of the node, and leaves at least ``least_child`` of H on each side.
    """
    s, layout = settings, Layout(cuts)
    use_checkpoints(frame.sparkSession)
    total, most, n_rows = frame.agg(F.sum(weight), F.max(weight), F.count("*")).first()
    bits = fixed_bits(total or 1.0, most or 1.0)
    wanted = max(1, int(s.columns * len(inputs)))
    n = len(inputs)

    packs = bundles(layout)

    def grow(held: _Spread | _Here) -> Trees:
        out = no_trees(s.rounds, s.depth)
        cut = np.zeros(out.feature.shape, np.int64)
        held.changed(_with_codes(packs), True)  # what made the blocks would be sent with each task
        since = 0
        for t in range(s.rounds):
            newer = _with_trees(packs, out.feature[since:t].copy(), cut[since:t].copy(), out.value[since:t].copy(), s.depth)
            if t - since == HELD_ROUNDS:
                held.changed(newer, t // CHECKPOINT_ROUNDS > since // CHECKPOINT_ROUNDS)
                since, newer = t, _with_trees(packs, out.feature[t:t], cut[t:t], out.value[t:t], s.depth)
            held.drawn(_draw(s, t, bits, newer))
            columns = chosen_inputs(s.seed, 2 * t, n, wanted)
            out.feature[t, 0] = -1
            sums = None
            for level in range(s.depth):
                asked = np.arange(2**level - 1, 2 ** (level + 1) - 1)
                if not (out.feature[t, asked] == -1).any():
                    break
                nodes = _fewer_rows(out, t, level)
                found = held.summed(_boost_sums(level, nodes, columns, layout, packs, out.feature[t], cut[t]), (len(nodes), layout.size, 3))
                sums = _with_siblings(found, nodes - asked[0], sums, len(asked))
                _boost_splits(out, cut, t, level, sums, layout, columns, bits, s)
            np.multiply(out.value[t], s.step, out=out.value[t])
        return out

    return _grown(blocks(frame, inputs, weight, cuts), grow, -(-n_rows // BOOSTED_ROWS), PASS_ROWS)


def _fewer_rows(out: Trees, t: int, level: int) -> np.ndarray:
    """The nodes of a level that are summed: the root, then that child of each split node which has fewer rows."""
    if level == 0:
        return np.array([0])
    above = np.arange(2 ** (level - 1) - 1, 2**level - 1)
    left = 2 * above[out.feature[t, above] >= 0] + 1
    return np.where(out.n_rows[t, left] <= out.n_rows[t, left + 1], left, left + 1)


def _with_siblings(found: np.ndarray, places: np.ndarray, above: np.ndarray | None, n: int) -> np.ndarray:
    """Sums of all ``n`` nodes of a level: those found, and what their siblings have of the sums of the level above."""
    out = np.zeros((n, *found.shape[1:]), np.int64)
    out[places] = found
    if above is not None:
        out[places ^ 1] = above[places >> 1] - found
    return out


def _walker(packs: list[Bundle], feature: np.ndarray, cut: np.ndarray, levels: int) -> Callable[[np.ndarray], np.ndarray]:
    """What finds, by its codes, the node of each row after ``levels`` steps down a tree that grows, or the leaf where it
    ended before.

    Each split has a bit, set for rows that go right; a bundle's code says which of its bits are set. The bits of the first
    levels together are the place of a row's way down in a table. Splits further down are asked one level at a time.
    """
    where = {f: (i, step) for i, b in enumerate(packs) for f, step in zip(b.inputs, b.steps)}
    every = np.arange(len(feature))

    def right(node: int) -> tuple[int, np.ndarray]:
        """The bundle that decides at a node, and which of its codes go right."""
        i, step = where[int(feature[node])]
        place = packs[i].inputs.index(int(feature[node]))
        above = packs[i].steps[place + 1] if place + 1 < len(packs[i].steps) else len(packs[i].marks)
        return i, np.arange(len(packs[i].marks)) % above // step > cut[node]

    upper = min(levels, LOOKED_UP)
    splits = np.flatnonzero(feature[: 2**levels - 1] >= 0)
    first = int((splits < 2**upper - 1).sum())
    steps = [splits[:first]]
    for level in range(upper, levels):
        own = splits[(splits >= 2**level - 1) & (splits < 2 ** (level + 1) - 1)]
        steps += [own[k : k + MASK_BITS // 2] for k in range(0, len(own), MASK_BITS // 2)]
    masks: list[dict[int, np.ndarray]] = [{}]
    used, asked = 0, []
    for own in steps:
        if used + len(own) > MASK_BITS:
            masks.append({})
            used = 0
        # The bit after the last one is never set: nodes that don't split keep their rows.
        child, bit = every.copy(), np.full(len(feature), MASK_BITS)
        for k, node in enumerate(own, used):
            i, go = right(node)
            masks[-1][i] = masks[-1].get(i, 0) | (go.astype(np.int64) << k)
            child[node], bit[node] = 2 * node + 1, k
        asked.append((len(masks) - 1, child, bit))
        used += len(own)
    ways = np.arange(1 << first)
    end = np.zeros(len(ways), np.int64)
    for _ in range(upper):
        end = asked[0][1][end] + (ways >> asked[0][2][end] & 1)

    def run(codes: np.ndarray) -> np.ndarray:
        found = []
        for tables in masks:
            mask = np.zeros(len(codes), np.int64)
            for i, table in tables.items():
                mask |= table.take(codes[:, i])
            found.append(mask)
        node = end.take(found[0] & (len(end) - 1))
        for at, child, bit in asked[1:]:
            turn = found[at] >> bit.take(node)
            turn &= 1
            node = child.take(node)
            node += turn
        return node

    return run


def _walked(codes: np.ndarray, packs: list[Bundle], feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    return _walker(packs, feature, cut, levels)(codes)


def _with_trees(packs: list[Bundle], feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int) -> Pass:
    """Blocks with the margins of some trees more, added one after the other."""
    walkers: list[Callable[[np.ndarray], np.ndarray]] = []

    def run(block: Block) -> Block:
        if not walkers:  # in the task, once for all its blocks
            walkers.extend(_walker(packs, f, c, depth) for f, c in zip(feature, cut))
        margin = block.margin
        for walk, v in zip(walkers, value):
            margin = margin + v.take(walk(block.codes))
        return block._replace(margin=margin)

    return Pass(run, "trees", lambda: sent(*_numbers(packs), [depth], feature, cut, value))


def _with_codes(packs: list[Bundle]) -> Pass:
    def run(block: Block) -> Block:
        kind = np.min_scalar_type(max(len(b.marks) for b in packs) - 1)
        codes = [sum((block.bins[:, f].astype(np.int64) * step for f, step in zip(b.inputs, b.steps)), np.int64(0)).astype(kind) for b in packs]
        label = block.label.astype(np.int8)
        return block._replace(
            bins=block.bins[:, :0], codes=np.stack(codes).T, label=label if np.array_equal(label, block.label) else block.label
        )

    return Pass(run, "codes", lambda: sent(*_numbers(packs)))


def _draw(s: BoostSettings, t: int, bits: int, newer: Pass) -> Pass:
    def run(block: Block) -> Drawn:
        block = newer(block)
        if s.rows >= 1:
            return Drawn(block.codes, *gradients(block.label, block.weight, block.margin, bits))
        own = np.flatnonzero(draws(block.key, s.seed, 2 * t + 1) < s.rows)
        codes = np.stack([c.take(own) for c in block.codes.T]).T
        return Drawn(codes, *gradients(block.label.take(own), block.weight.take(own), block.margin.take(own), bits))

    return Pass(run, "draw", lambda: newer.sent() + sent(_salt(s.seed, 2 * t + 1), [s.rows, 2.0**bits]))


def _boost_sums(level: int, nodes: np.ndarray, columns: np.ndarray, layout: Layout, packs: list[Bundle], feature: np.ndarray, cut: np.ndarray):
    """Sums of blocks per (node asked for, bin) of the drawn inputs: first and second derivatives, and rows."""
    size, feature, cut, m = layout.size, feature.copy(), cut.copy(), len(nodes)
    slot = np.full(2 ** (level + 1), -1)
    slot[nodes] = np.arange(m)
    wanted = np.zeros(size, bool)
    for f in columns:
        wanted[layout.first[f] : layout.first[f + 1]] = True

    inputs = set(columns.tolist())

    def run(blocks: Iterable[Drawn]) -> np.ndarray:
        walk = _walker(packs, feature, cut, level) if level else None
        asked = [i for i, bundle in enumerate(packs) if inputs & set(bundle.inputs)]
        held = {i: np.zeros((3, m * len(packs[i].marks)), np.int64) for i in asked}
        for block in blocks:
            at, own, g, h = None, None, block.g, block.h
            if level:
                at = slot.take(walk(block.codes))
                own = np.flatnonzero(at >= 0)
                at, g, h = at.take(own), g.take(own), h.take(own)
            for i in asked:
                place = block.codes[:, i].astype(np.int64) if own is None else block.codes[:, i].take(own) + at * len(packs[i].marks)
                for k, what in enumerate((g, h, None)):
                    # Whole numbers below 2**53 in a block, so they are exact.
                    held[i][k] += np.bincount(place, what, minlength=held[i].shape[1]).astype(np.int64, copy=False)
        out = np.zeros((m, size, 3), np.int64)
        for i in asked:
            cells = held[i].reshape(3, m, -1)
            marks = packs[i].marks.astype(np.float64)
            # In two parts below 2**53 each, so that the products are exact.
            high, low = ((part.astype(np.float64) @ marks).astype(np.int64) for part in (cells >> 26, cells & ((1 << 26) - 1)))
            out[:, packs[i].places, :] = np.moveaxis((high << 26) + low, 0, 2)
        out[:, ~wanted] = 0
        return out

    return Pass(run, "boost", lambda: sent(*_numbers(packs), [level, m, size], slot, columns, feature, cut))


def _boost_splits(out: Trees, cut: np.ndarray, t: int, level: int, sums: np.ndarray, layout: Layout, columns: np.ndarray, bits: int, s: BoostSettings) -> None:
    """Split the nodes of a level where it gains, and give their children a leaf's value."""
    upto, whole = layout.prefix(sums)
    scale = 2.0**-bits
    gl, hl = upto[..., 0] * scale, upto[..., 1] * scale
    gr, hr = (whole[..., 0] - upto[..., 0]) * scale, (whole[..., 1] - upto[..., 1]) * scale
    square = lambda g, h: g * g / (h + s.penalty)
    gain = square(gl, hl) + square(gr, hr) - square(gl + gr, hl + hr)
    gain[:, ~layout.split_places()] = -np.inf
    gain[(hl < s.least_child) | (hr < s.least_child)] = -np.inf
    best = _best(np.where(np.isfinite(gain), gain, -1.0))
    any_bin = layout.first[columns[0]]
    for i in range(len(sums)):
        node = 2**level - 1 + i
        if out.feature[t, node] != -1:
            continue
        g, h, n = whole[i, any_bin]
        out.n_rows[t, node], out.weight[t, node] = n, h * scale
        out.value[t, node] = -g * scale / (h * scale + s.penalty)
        place = int(best[i])
        if gain[i, place] <= LEAST_GAIN:
            continue
        out.feature[t, node], cut[t, node], out.threshold[t, node] = layout.at(place)
        out.gain[t, node] = gain[i, place]
        for child, a, b, c in ((2 * node + 1, gl, hl, upto[i, place, 2]), (2 * node + 2, gr, hr, whole[i, place, 2] - upto[i, place, 2])):
            out.feature[t, child] = -1
            out.n_rows[t, child], out.weight[t, child] = c, b[i, place]
            out.value[t, child] = -a[i, place] / (b[i, place] + s.penalty)


# Forests.


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 300
    depth: int = 8
    least_leaf: int = 20
    #: Inputs that a node looks at; the root of their number if None.
    inputs: int | None = None
    bootstrap: bool = True
    seed: int = 42


#: Chances of at most 0, 1, 2 ... draws of a row, of a Poisson number with mean one: a fixed rule, 1 / (e * k!) summed.
POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(range(1, k + 1))) for k in range(16)])


def forest(frame: DataFrame, inputs: Sequence[str], weight: str, cuts: list[np.ndarray], settings: ForestSettings = ForestSettings()) -> Trees:
    """Trees of least weighted Gini impurity, each on rows drawn with putting back and, per node, on inputs drawn without.

    How often a tree has a row is a Poisson draw from the row's key. A leaf holds ``least_leaf`` different rows at
    least; its value is the weighted share of class 1.
    """
    s, layout = settings, Layout(cuts)
    found = frame.groupBy("label").agg(F.max(weight).alias("w"), F.count("*").alias("n")).collect()
    class_weight = np.array([next((r["w"] for r in found if r["label"] == c), 0.0) for c in (0, 1)])
    wanted = s.inputs or max(1, int(len(inputs) ** 0.5))
    n, slots = len(inputs), max(1, SUM_BYTES // (24 * layout.size))

    def grow(held: _Spread | _Here) -> Trees:
        out = no_trees(s.trees, s.depth)
        cut = np.zeros(out.feature.shape, np.int64)
        out.feature[:, 0] = -1
        for level in range(max(1, s.depth)):
            growing = [(t, 2**level - 1 + j) for t in range(s.trees) for j in range(2**level) if out.feature[t, 2**level - 1 + j] == -1]
            for start in range(0, len(growing), slots):
                nodes = np.array(growing[start : start + slots])
                asked = np.array([chosen_inputs(s.seed, t * 2 ** (s.depth + 1) + node + 1, n, wanted) for t, node in nodes.tolist()])
                sums = _forest_sums(s, level, nodes, asked, layout, out.feature, cut)
                best = held.chosen(sums, (len(nodes), layout.size, 3), _forest_choice(asked, layout, class_weight, s))
                _forest_splits(out, cut, level, nodes, [np.concatenate(x) for x in zip(*best)], layout, s)
        return out

    return _grown(blocks(frame, inputs, weight, cuts), grow, -(-sum(r["n"] for r in found) // FOREST_ROWS), BLOCK_ROWS)


#: Parts of the range from 0 to 1, the least Poisson draw in each, and the first part where more than two draws meet.
_PARTS = 4096
_LEAST_DRAW = np.searchsorted(POISSON, np.arange(_PARTS) / _PARTS, side="right")
_SEVERAL = int(np.flatnonzero(np.diff(np.append(_LEAST_DRAW, len(POISSON))) > 1)[0])


def poisson(u: np.ndarray) -> np.ndarray:
    """The Poisson number with mean one of each even number: how many of POISSON are not above it."""
    part = (u * _PARTS).astype(np.int64)
    out = _LEAST_DRAW.take(part)
    out += u >= POISSON.take(np.minimum(out, len(POISSON) - 1))
    late = np.flatnonzero(part >= _SEVERAL)
    out[late] = np.searchsorted(POISSON, u[late], side="right")
    return out


def _forest_sums(s: ForestSettings, level: int, nodes: np.ndarray, asked: np.ndarray, layout: Layout, feature: np.ndarray, cut: np.ndarray):
    """Sums of a block per (node, bin) of the inputs that the node looks at: draws of class 0 and of class 1, and rows."""
    first, size = layout.first, layout.size
    trees = np.unique(nodes[:, 0])
    feature, cut = feature[trees], cut[trees]

    def run(block: Block) -> np.ndarray:
        n, flat = len(block.label), block.bins.T.ravel()
        class_one = block.label.astype(np.int64)
        shift = n.bit_length()  # rows fill the lower bits of a sum, draws those above: one count for both
        out = np.zeros((len(nodes) * size, 3), np.int64)
        for i, t in enumerate(trees.tolist()):
            slots = np.flatnonzero(nodes[:, 0] == t)
            slot = np.full(2 ** (level + 1), -1)
            slot[nodes[slots, 1]] = np.arange(len(slots))
            times = poisson(draws(block.key, s.seed, t)) if s.bootstrap else np.ones(n, np.int64)
            own = np.flatnonzero(times)
            node = np.zeros(len(own), np.int64)
            for _ in range(level):
                node = _stepped(block.bins, own, node, feature[i], cut[i])
            at = slot.take(node)
            here = np.flatnonzero(at >= 0)
            own, at = own.take(here), at.take(here)
            packed = ((times.take(own) << shift) + 1).astype(np.float64)
            of_class = class_one.take(own)
            both = np.zeros(2 * len(slots) * size)
            for f in asked[slots].T:
                place = (np.arange(len(slots)) * size + first[f]).take(at)
                place += flat.take((f * n).take(at) + own)
                place *= 2
                place += of_class
                both += np.bincount(place, packed, minlength=len(both))
            counts = both.astype(np.int64).reshape(-1, 2)
            low, high = int(slots[0]) * size, (int(slots[-1]) + 1) * size
            out[low:high, :2] = counts >> shift
            out[low:high, 2] = (counts & ((1 << shift) - 1)).sum(axis=1)
        return out.reshape(len(nodes), size, 3)

    def numbers() -> bytes:
        slot = np.full((len(trees), 2 ** (level + 1)), -1)
        slot[np.searchsorted(trees, nodes[:, 0]), nodes[:, 1]] = np.arange(len(nodes))
        salts = np.concatenate([_salt(s.seed, t) for t in trees.tolist()]).view(np.int64)
        above = slice(max(1, 2**level - 1))
        return sent(
            [level, len(nodes), size, asked.shape[1], s.bootstrap], first, POISSON, salts, slot, asked, feature[:, above], cut[:, above]
        )

    return Pass(run, "forest", numbers)


def _forest_choice(asked: np.ndarray, layout: Layout, class_weight: np.ndarray, s: ForestSettings):
    """Per node of a slice of the sums: the best place, whether the impurity falls there, by how much, and the rows and the
    weight per class of the node and of its left side."""

    def run(start: int, sums: np.ndarray) -> tuple:
        upto, whole = layout.prefix(sums)
        left, both = upto[..., :2] * class_weight, whole[..., :2] * class_weight
        right = both - left
        purity = lambda w: (w * w).sum(axis=-1) / np.maximum(w.sum(axis=-1), 1e-300)
        gain = purity(left) + purity(right) - purity(both)
        rows, all_rows = upto[..., 2], whole[..., 2]
        fit = layout.split_places() & (rows >= s.least_leaf) & (all_rows - rows >= s.least_leaf) & (gain > 1e-9 * both.sum(axis=-1))
        best = _best(np.where(fit, gain, -1.0))
        i = np.arange(len(sums))
        seen = layout.first[asked[start : start + len(sums), 0]]
        return best, fit[i, best], gain[i, best], all_rows[i, seen], both[i, seen], all_rows[i, best], both[i, best], rows[i, best], left[i, best]

    return Pass(run, "choice", lambda: sent(layout.first, layout.first[asked[:, 0]], [s.least_leaf], class_weight))


def _forest_splits(out: Trees, cut: np.ndarray, level: int, nodes: np.ndarray, found: list[np.ndarray], layout: Layout, s: ForestSettings) -> None:
    """Split nodes of a level where the impurity falls, and give their children a leaf's value."""
    best, fit, gain, own_rows, own, all_rows, both, rows, left = found

    def hold(t: int, node: int, n: int, weights: np.ndarray) -> None:
        out.n_rows[t, node], out.weight[t, node] = n, weights.sum()
        out.value[t, node] = weights[1] / weights.sum() if weights.sum() else 0.0

    for i, (t, node) in enumerate(nodes.tolist()):
        hold(t, node, own_rows[i], own[i])
        if level >= s.depth or not fit[i]:
            continue
        out.feature[t, node], cut[t, node], out.threshold[t, node] = layout.at(int(best[i]))
        out.gain[t, node] = gain[i]
        out.feature[t, 2 * node + 1] = out.feature[t, 2 * node + 2] = -1
        hold(t, 2 * node + 1, rows[i], left[i])
        hold(t, 2 * node + 2, all_rows[i] - rows[i], both[i] - left[i])


# What is stored, and scoring.


def ledger(spark: SparkSession, trees: Trees, inputs: Sequence[str]) -> DataFrame:
    """One row per node: its split with the gain (nulls at a leaf), its rows, their weight, and its value."""
    rows = []
    for t, node in zip(*np.nonzero(trees.feature != -2)):
        f = int(trees.feature[t, node])
        split = (inputs[f], float(trees.threshold[t, node]), float(trees.gain[t, node])) if f >= 0 else (None, None, None)
        rows.append((int(t), int(node), *split, int(trees.n_rows[t, node]), float(trees.weight[t, node]), float(trees.value[t, node])))
    return spark.createDataFrame(rows, LEDGER)


def from_ledger(table: DataFrame, inputs: Sequence[str]) -> Trees:
    """The trees of a stored ledger, which has a row per node and not per training row."""
    rows = table.collect()
    last = max(r["node"] for r in rows)
    out = no_trees(1 + max(r["tree"] for r in rows), int(last + 1).bit_length() - 1)
    place = {name: i for i, name in enumerate(inputs)}
    for r in rows:
        at = r["tree"], r["node"]
        out.feature[at] = -1 if r["feature"] is None else place[r["feature"]]
        out.threshold[at], out.gain[at] = r["threshold"] or 0.0, r["gain"] or 0.0
        out.n_rows[at], out.weight[at], out.value[at] = r["n_rows"], r["weight"], r["value"]
    return out


#: Rows whose ways down a tree are followed at once: their ranks fit a core's cache.
SCORED_ROWS = 1 << 13


def scorer(trees: Trees, boosted: bool) -> Callable[[np.ndarray], np.ndarray]:
    """What gives rows (row, input) the probability of class 1: from the sum of the leaves' margins, or the mean of the
    leaves' shares, added tree by tree.

    A value is as good as its rank among the thresholds of its input. Leaves go on to the last level, always to the left.
    """
    depth, inner = trees.depth, 2**trees.depth - 1
    feature, value = trees.feature.astype(np.int64), trees.value.copy()
    for node in range(inner):
        leaf = feature[:, node] < 0
        for child in (2 * node + 1, 2 * node + 2):
            feature[leaf, child], value[leaf, child] = -1, value[leaf, node]
    feature, bottom = feature[:, :inner], np.ascontiguousarray(value[:, inner:])
    used = np.unique(feature[feature >= 0]).tolist()
    edges = [np.unique(trees.threshold[:, :inner][feature == f]) for f in used]
    kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16
    highest = np.full(feature.shape, np.iinfo(kind).max, kind)
    place = np.zeros(feature.shape, np.int64)
    for i, (f, own) in enumerate(zip(used, edges)):
        here = feature == f
        highest[here] = np.searchsorted(own, trees.threshold[:, :inner][here])
        place[here] = i

    def run(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for start in range(0, len(x), SCORED_ROWS):
            rows = x[start : start + SCORED_ROWS]
            ranks = np.zeros((max(1, len(used)), len(rows)), kind)
            for i, (f, own) in enumerate(zip(used, edges)):
                # What is no number is not above any threshold.
                ranks[i] = np.where(np.isnan(rows[:, f]), 0, np.searchsorted(own, rows[:, f], side="right"))
            flat, row, first = ranks.ravel(), np.arange(len(rows)), place * len(rows)
            total = out[start : start + SCORED_ROWS]
            for begin, most, leaf in zip(first, highest, bottom):
                node = np.zeros(len(rows), np.int64)
                for _ in range(depth):
                    at = begin.take(node)
                    at += row
                    right = flat.take(at) > most.take(node)
                    node <<= 1
                    node += 1
                    node += right
                node -= inner
                total += leaf.take(node)
        return 1.0 / (1.0 + np.exp(-out)) if boosted else out / len(feature)

    return run


def probabilities(trees: Trees, x: np.ndarray, boosted: bool) -> np.ndarray:
    """The probability of class 1 of each row of ``x`` (row, input)."""
    return scorer(trees, boosted)(x)


def with_tree_probability(df: DataFrame, trees: Trees, inputs: Sequence[str], name: str, boosted: bool) -> DataFrame:
    """``df`` with the probability ``name``; rows are scored in columnar batches. A null input stops the job."""
    held = df.sparkSession.sparkContext.broadcast(tuple(trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(Trees(*held.value), boosted)
        for batch in batches:
            p = score(_values(batch, inputs))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, DoubleType())]))
