"""SimHash near duplicates through an inverted index on positional bytes.

A fingerprint has eight positional bytes. Two that differ in at most d bits agree in at least 8 - d of them:
the guaranteed minimum of matches. A posting list for one byte would hold 1/256 of all fingerprints, so
the lists here are those of several positions together, chosen such that any set of 8 - d matching positions
contains one of them. Within a list the shared positional bytes of each pair are tallied, pairs that reach the
minimum are retained, and their bits are compared. Equal fingerprints meet as one node, long lists are cut into
cells of bounded size that meet pairwise, and a cell gives at most one link per member, so a group of copies
never turns into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wardstat.llm import bytescan
from wardstat.llm.common import aside, chunks, fresh, stored, text_of
from wardstat.llm.components import connected_components

U = np.uint64
#: Members of a posting list that are compared in one cell with as many others.
CELL = 4096
#: Lists up to this length are compared pair by pair across a whole batch.
SHORT = 16
#: Columns that near_duplicates adds.
ADDED = ("_fp", "_row", "_part", "_component")
LANES = U(0x0001000100010001)
SEVENS = U(0x7F7F7F7F7F7F7F7F)


def fingerprints_of(texts: pa.Array, shingle: int = 4) -> np.ndarray:
    """The unsigned fingerprint of each text; 0 for a text without words."""
    w = bytescan.words(*bytescan.raw(texts), lower=True)
    out = np.zeros(len(texts), U)
    if not len(w.doc):
        return out
    count = np.bincount(w.doc, minlength=len(texts))
    head = bytescan.windows(w, shingle)
    end = w.end[head + shingle - 1]
    doc = w.doc[head]
    few = np.flatnonzero((count > 0) & (count < shingle))
    if len(few):  # fewer words than a shingle: the whole sequence
        first = np.cumsum(count) - count
        head = np.concatenate([head, first[few]])
        end = np.concatenate([end, w.end[first[few] + count[few] - 1]])
        doc = np.concatenate([doc, few])
        order = np.argsort(doc, kind="stable")
        head, end, doc = head[order], end[order], doc[order]
    start = w.start[head]
    h = bytescan.xxh64(w.data, start, end - start)
    # Four 16-bit counters share a word; a run of fewer than 65,536 shingles cannot overflow one.
    change = np.flatnonzero(np.diff(doc, prepend=-1))
    size = np.diff(change, append=len(doc))
    runs = np.concatenate([np.arange(a, a + n, 65_535) for a, n in zip(change, size)]) if size.max() > 65_535 else change
    votes = np.empty((len(runs), 64), np.int64)
    for i in range(16):
        lanes = np.add.reduceat((h >> U(i)) & LANES, runs)
        for k in range(4):
            votes[:, i + 16 * k] = (lanes >> U(16 * k)) & U(0xFFFF)
    if len(runs) != len(change):
        votes = np.add.reduceat(votes, np.searchsorted(runs, change), axis=0)
    bits = (2 * votes > size[:, None]).astype(U)
    out[doc[change]] = (bits << np.arange(64, dtype=U)).sum(axis=1, dtype=U)
    return out


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "_fp", shingle: int = 4) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text``; a null text has no words, so 0."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    columns, plain = docs.columns, fresh([*docs.columns, name], "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, plain):
            fp = fingerprints_of(part.column(plain), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(fp)], [*columns, name])

    return docs.select("*", text_of(text).alias(plain)).mapInArrow(run, schema)


def covering_positions(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any 8 - max_bits positions contain one of them."""
    matches = 8 - max_bits
    if not 1 <= matches <= 8:
        raise ValueError("max_bits must be 0 to 7")
    width = min(3, matches)
    open_sets = {frozenset(x) for x in combinations(range(8), matches)}
    chosen = []
    while open_sets:
        best = max(combinations(range(8), width), key=lambda c: sum(s.issuperset(c) for s in open_sets))
        chosen.append(best)
        open_sets = {s for s in open_sets if not s.issuperset(best)}
    return chosen


def _posting(k: int, positions: tuple[int, ...], fp: Column) -> Column:
    key = F.lit(k)
    for p in positions:
        key = key * 256 + F.shiftrightunsigned(fp, 8 * p).bitwiseAND(255)
    return key.cast("long")


def _near(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Of XORed pairs: shared positional bytes tallied, then the bits of the retained pairs counted."""
    shared = np.bitwise_count(~((((x & SEVENS) + SEVENS) | x) | SEVENS))
    near = shared >= 8 - max_bits
    near[near] = np.bitwise_count(x[near]) <= max_bits
    return near


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The members of one list that hang together, each with one link to the first of its part."""
    left, one, other = fps, [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = _near(left ^ front.pop(), max_bits)
            found, left = left[near], left[~near]
            front.extend(found)
            one.append(np.full(len(found), root, U))
            other.append(found)
    return (np.concatenate(one), np.concatenate(other)) if one else (fps[:0], fps[:0])


def _links(cell: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    head = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)) if len(cell) else np.zeros(0, np.int64)
    size = np.diff(head, append=len(cell))
    one, other = [fps[:0]], [fps[:0]]
    for i in np.flatnonzero(size > SHORT):
        a, b = _forest(fps[head[i] : head[i] + size[i]], max_bits)
        one.append(a)
        other.append(b)
    left = np.repeat(np.where(size <= SHORT, size, 0), size)
    place = np.arange(len(cell)) - np.repeat(head, size)
    for d in range(1, SHORT):
        i = np.flatnonzero(place + d < left)
        if not len(i):
            break
        i = i[_near(fps[i] ^ fps[i + d], max_bits)]
        one.append(fps[i])
        other.append(fps[i + d])
    return np.concatenate(one), np.concatenate(other)


def fingerprint_links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``nodes`` (column fp) that join all those within ``max_bits``."""
    fp = F.col("fp")
    lists = [_posting(k, p, fp) for k, p in enumerate(covering_positions(max_bits))]
    postings = nodes.select("fp", F.explode(F.array(*lists)).alias("key"))
    long = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    long = long.select("key", F.ceil(F.col("n") / CELL).alias("parts"))
    cells = (
        postings.join(long, "key", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("fp"), "parts"))
        .select("fp", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("met"))
        .select("key", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)])
            if not len(rows):
                continue
            begins = np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            last = int(np.flatnonzero(begins)[-1])
            yield from emit(rows[:last], begins[:last])
            held = rows[last:]
        if len(held):
            yield from emit(held, np.arange(len(held)) == 0)

    def emit(rows: np.ndarray, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = _links(np.cumsum(begins), np.ascontiguousarray(rows[:, 3]).view(U), max_bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    order = ["key", "low", "high"]
    return cells.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def components(marked: DataFrame, key: str = "doc_id", max_bits: int = 4) -> DataFrame:
    """Rows with ``_fp``, here stored once, with ``_row`` (a unique number), ``_part`` (one number for each group) and
    ``_component``: the smallest key that fingerprints within ``max_bits`` reach, step by step.

    Null keys are never the smallest unless a group has no other. Repeated rows stay rows of one group.
    """
    rows = stored(marked.withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    nodes = stored(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min(f"`{key}`").alias("least")), "nodes")
    parts = connected_components(fingerprint_links(nodes.select("fp"), max_bits), "a", "b")
    placed = nodes.join(parts, nodes.fp == parts.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("_part")
    )
    placed = stored(placed, "parts")
    # Stored as well: joins of plain shuffles can be split where a group or a fingerprint holds much.
    least = stored(placed.groupBy("_part").agg(F.min("least").alias("_component")), "least-keys")
    named = placed.join(least, "_part").select(F.col("fp").alias("_fp"), "_part", "_component")
    return rows.join(named, "_fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` (all its columns) with the columns of ``components``.

    Null and empty texts have fingerprint 0, are equal to each other and linked like others. Columns of ``docs``
    with one of the added names are replaced.
    """
    own = [f"`{c}`" for c in docs.columns if c.lower() not in ADDED]
    return components(with_fingerprint(docs.select(own), text, "_fp", shingle), key, max_bits)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest key, of equal keys any one row.
    The columns of ``docs`` stay as they are."""
    renamed, back = aside(docs, *ADDED)
    marked = near_duplicates(renamed, key, text, shingle, max_bits)
    kept = marked.where(F.col(f"`{key}`").eqNullSafe(F.col("_component"))).groupBy("_part").agg(F.min("_row").alias("_row"))
    return marked.join(kept, "_row", "left_semi").drop(*ADDED).withColumnsRenamed(back).select([f"`{c}`" for c in docs.columns])
