"""MinHash near duplicates: one permutation, optimal densification, bands, star-shaped candidates.

Each shingle of a document is hashed once; the hash chooses a bin and the least hash in each bin is its minimum. An
empty bin borrows the minimum of the first occupied bin in a random order of its own, the same for all documents, so
bins agree in the share that the sets have in common, however few shingles there are. Bins are grouped into bands, and
documents that agree in a band share a bucket. A bucket gives no pairs but a star: its members are candidates with its
centre, each document with the eight centres that it shares most buckets with. Candidates are confirmed on their full sets.
Buckets whose members still hang in several groups give further stars about other centres; what is left then is gone
through pairwise within bounded cells, by sketches and then by full sets. A cell gives the links that join its members,
fewer than it has members, and no row for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstat.llm import bytescan
from wardstat.llm.cells import cut, pairs, together, whole
from wardstat.llm.common import aside, chunks, sql_type, stored, text_of
from wardstat.llm.components import connected_components
from wardstat.session import discard

U = np.uint64
#: Bins, and bins of a band. At a similarity of 0.85 a pair misses all 40 bands once in 10**8.
BINS, ROWS = 240, 6
BANDS = BINS // ROWS
#: Sketches of two documents at the wanted similarity agree in fewer bins than that minus so many standard errors never.
ERRORS = 5
#: Times that the buckets give stars, each time about other centres, and the centres that a document is compared with each
#: time, those first that it shares most buckets with. What these leave is gone through whole.
STARS, CENTRES = 2, 8
#: Members of a bucket that are compared in one cell with as many others, and the shingles that these have at most, but for
#: a larger set.
CELL, CELL_SHINGLES = 2048, 1 << 21
#: Documents whose bins a worker holds at once.
HELD = 2048
#: Columns that ``keep_one`` works with.
ADDED = ("_mh_row", "_mh_n", "_mh_component", "_mh_kept")


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(33))) * bytescan.P2
        x = (x ^ (x >> U(29))) * bytescan.P3
    return x ^ (x >> U(32))


def _orders() -> np.ndarray:
    """For each bin the order in which it asks the others, from a hash of both."""
    place = np.arange(BINS, dtype=U)
    return np.argsort(_mixed((place[:, None] * U(BINS) + place + U(1)) * bytescan.P1), axis=1)


ORDERS = _orders()


def shingle_sets(texts: pa.Array, shingle: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles, sorted. A text of fewer words has its whole sequence as the only one."""
    w = bytescan.words(*bytescan.raw(texts), lower=True)
    if not len(w.doc):
        return np.zeros(0, np.int64), np.zeros(0, U)
    count = np.bincount(w.doc, minlength=len(texts))
    head = bytescan.windows(w, shingle)
    first = np.cumsum(count) - count
    few = np.flatnonzero((count > 0) & (count < shingle))
    doc = np.concatenate([w.doc[head], few])
    start = np.concatenate([w.start[head], w.start[first[few]]])
    end = np.concatenate([w.end[head + shingle - 1], w.end[first[few] + count[few] - 1]])
    h = bytescan.xxh64(w.data, start, end - start)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
    return doc[new], h[new]


def sketches(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """The densified minima (n, BINS) of sorted sets; a text without shingles has zeros."""
    out, full = np.zeros((n, BINS), U), np.zeros((n, BINS), bool)
    bins = ((h >> U(40)) * U(BINS) >> U(24)).astype(np.int64)
    # Hashes are sorted within a text and bins follow their order, so the first hash of a bin is the least.
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (bins[1:] != bins[:-1])]) if len(h) else np.zeros(0, bool)
    out[doc[new], bins[new]] = h[new]
    full[doc[new], bins[new]] = True
    at, bin_ = np.nonzero(~full & full.any(axis=1)[:, None])
    for step in range(BINS):
        if not len(at):
            break
        asked = ORDERS[bin_, step]
        hit = full[at, asked]
        out[at[hit], bin_[hit]] = out[at[hit], asked[hit]]
        at, bin_ = at[~hit], bin_[~hit]
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    grouped = minima.reshape(len(minima), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), (len(minima), BANDS))
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = _mixed(key * bytescan.P4 + grouped[:, :, r])
    return key


def _digests(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Two sums over each set that tell sets apart."""
    out = np.zeros((2, n), U)
    if len(doc):
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        for k, mixed in enumerate((_mixed(h), _mixed(h ^ bytescan.P5))):
            out[k, doc[first]] = np.add.reduceat(mixed, first)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _marks(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(key, th, n, d1, d2, keys, sketch) per row: hash of the text, size and digests of the set, band keys, and one byte
    of each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            for begin in range(0, chunk.num_rows, HELD):
                part = chunk.slice(begin, HELD)
                doc, h = shingle_sets(part.column("text"), shingle)
                rows = part.num_rows
                minima = sketches(doc, h, rows)
                size = np.bincount(doc, minlength=rows)
                offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), _signed(band_keys(minima[size > 0]).ravel()))
                tags = (_mixed(minima) >> U(56)).astype(np.uint8).tobytes()
                tags = pa.array([tags[i * BINS : i * BINS + BINS] for i in range(rows)], pa.binary())
                d1, d2 = _digests(doc, h, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("th"), pa.array(size), _signed(d1), _signed(d2), keys, tags],
                    ["key", "th", "n", "d1", "d2", "keys", "sketch"],
                )

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(text_of(text)).alias("th"), text_of(text).alias("text"))
    kind = sql_type(docs, key).simpleString()
    return rows.mapInArrow(run, f"key {kind}, th long, n long, d1 long, d2 long, keys array<long>, sketch binary")


def least_bins(percent: int) -> int:
    """How many bins of a pair of the wanted similarity agree at the very least."""
    share = percent / 100
    return int(BINS * (share - ERRORS * (share * (1 - share) / BINS) ** 0.5))


def _tags(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _fits(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int, least: int) -> np.ndarray:
    """Whether sizes and sketches of pairs allow the wanted similarity."""
    size = 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
    size[size] = (x[size] == y[size]).sum(axis=1) >= least
    return size


def _plausible(candidates: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    least = least_bins(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            fit = _fits(_tags(c["x"]), _tags(c["y"]), c["nx"].to_numpy(), c["ny"].to_numpy(), percent, least)
            yield batch.select(["a", "b"]).filter(pa.array(fit))

    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("sketch").alias("x"))
    other = nodes.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("sketch").alias("y"))
    return candidates.join(one, "a").join(other, "b").select("a", "b", "nx", "ny", "x", "y").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, text: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(node, set) for the nodes ``wanted`` (node, th, d1, d2), from one text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in chunks(batches):
            th = part.column("th").to_numpy()
            new = np.array([not (x in seen or seen.add(x)) for x in th.tolist()], bool)
            if len(seen) > 1 << 20:  # a text that comes twice costs time, no more
                seen.clear()
            part = part.filter(pa.array(new))
            doc, h = shingle_sets(part.column("text"), shingle)
            d1, d2 = _digests(doc, h, part.num_rows)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(offsets), _signed(h))
            yield pa.RecordBatch.from_arrays([_signed(d1), _signed(d2), sets], ["d1", "d2", "set"])

    asked = stored(wanted.select("th").distinct(), "minhash-asked")
    rows = docs.select(F.xxhash64(text_of(text)).alias("th"), text_of(text).alias("text")).join(asked, "th", "left_semi")
    sets = rows.mapInArrow(run, "d1 long, d2 long, set array<long>").groupBy("d1", "d2").agg(F.any_value("set").alias("set"))
    return sets.join(wanted, ["d1", "d2"]).select("node", "set")


def _confirmed(pairs_: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the wanted similarity."""
    pairs_ = stored(pairs_, "minhash-pairs")
    wanted = nodes.select("node", "th", "d1", "d2").join(pairs_.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")
    sets = stored(_sets(docs, text, shingle, wanted), "minhash-sets")
    both = pairs_.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    rows = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    found = stored(rows.where(f"100L * shared >= {int(percent)} * (total - shared)").select("a", "b"), "minhash-links")
    discard(pairs_, sets)
    return found


def _mixed_buckets(postings: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """The members (key, node, part) of all buckets, and the buckets (key, centre, inner) whose members hang in several
    parts, each with the centre of this turn and the part it hangs in."""
    named = stored(postings.join(labels, "node").select("key", "node", "part"), "minhash-members")
    order = F.xxhash64("node", F.lit(turn))
    found = named.groupBy("key").agg(
        F.min("part").alias("p"), F.max("part").alias("q"), F.min_by("node", order).alias("centre"), F.min_by("part", order).alias("inner")
    )
    return named, stored(found.where("p <> q").select("key", "centre", "inner"), "minhash-mixed")


def _stars(named: DataFrame, mixed: DataFrame) -> DataFrame:
    """For each document that meets centres of other parts those it shares most buckets with: pairs (a, b)."""
    met = named.join(mixed, "key").where("part <> inner").groupBy("node", "centre").agg(F.count("*").alias("times"))
    # A document has a row per band at most.
    nth = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("times"), "centre"))
    best = met.withColumn("nth", nth).where(F.col("nth") <= CENTRES)
    return best.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()


class _Joined:
    """Which parts links join, found out as they come."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, part: int) -> int:
        while (up := self.above.get(part, part)) != part:
            self.above[part] = self.above.get(up, up)
            part = up
        return part

    def join(self, a: int, b: int) -> bool:
        """Whether that was new."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[a] = b
        return a != b


def _joining(i: np.ndarray, j: np.ndarray, part: np.ndarray, sets: pa.ListArray, joined: _Joined, percent: int) -> list[tuple[int, int]]:
    """Those pairs of rows that have the wanted similarity by full sets and join two parts. ``i`` rises."""
    if not len(i):
        return []
    rows = np.unique(np.concatenate([i, j]))
    own = sets.take(pa.array(rows))
    ids = np.unique(own.flatten().to_numpy(), return_inverse=True)[1]
    size = own.value_lengths().to_numpy().astype(np.int64)
    first = np.cumsum(size) - size
    held = np.zeros(int(ids.max()) + 1, bool)
    out = []
    starts = np.flatnonzero(np.diff(i, prepend=-1))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(i)]):
        x = int(np.searchsorted(rows, i[start]))
        root = joined.root(int(part[i[start]]))
        others = [y for y in j[start:stop].tolist() if joined.root(int(part[y])) != root]
        if not others:
            continue
        at = np.searchsorted(rows, others)
        mine = ids[first[x] : first[x] + size[x]]
        held[mine] = True
        ends = np.cumsum(size[at])
        begins = ends - size[at]
        asked = ids[np.repeat(first[at] - begins, size[at]) + np.arange(ends[-1])]
        shared = np.add.reduceat(held[asked], begins, dtype=np.int64)
        held[mine] = False
        near = 100 * shared >= percent * (size[x] + size[at] - shared)
        for y in np.array(others)[near].tolist():
            if joined.join(int(part[i[start]]), int(part[y])):
                out.append((int(i[start]), y))
    return out


def _left_over(
    named: DataFrame, mixed: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, shingle: int, percent: int
) -> DataFrame:
    """Links (a, b), by full sets, that join all parts which share a bucket and have a pair of the wanted similarity there.

    Cells are gone through twice: by sketches, for the members that some other one may be similar to whose first shared
    bucket is this one, then with the full sets of these. A task looks at all their pairs, but for those whose parts its
    links join already.
    """
    least = least_bins(percent)
    carried = ["key", "low", "high", "own", "node", "part", "n"]

    def plausible(rows: pa.RecordBatch, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        c = {name: rows.column(name).to_numpy() for name in carried}
        tags = _tags(rows.column("sketch"))
        for i, j in pairs(begins, rows.num_rows, 1 << 16):
            fit = (c["part"][i] != c["part"][j]) & ((c["low"][i] == c["high"][i]) | (c["own"][i] != c["own"][j]))
            i, j = i[fit], j[fit]
            fit = _fits(tags[i], tags[j], c["n"][i], c["n"][j], percent, least)
            yield i[fit], j[fit]

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins in whole(batches):
            hit = np.zeros(rows.num_rows, bool)
            key, keys = rows.column("key").to_numpy(), rows.column("keys").flatten().to_numpy().reshape(-1, BANDS)
            for i, j in plausible(rows, begins):
                first = (keys[i] == keys[j]).argmax(axis=1)
                own = keys[i, first] == key[i]
                hit[i[own]] = hit[j[own]] = True
            yield rows.select(carried).filter(pa.array(hit))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = _Joined()
        for rows, begins in whole(batches):
            node, part = (rows.column(name).to_numpy() for name in ("node", "part"))
            for i, j in plausible(rows, begins):
                found = _joining(i, j, part, rows.column("set"), joined, percent)
                if found:
                    a, b = node[np.array(found).T]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    # Rows are cut into cells before they get what is wide, so that this is shuffled once.
    sizes = named.join(mixed.select("key"), "key").join(nodes.select("node", "n"), "node").select("key", "node", "part", "n")
    met = stored(cut(sizes, CELL, "n", CELL_SHINGLES), "minhash-met")
    rows = met.join(nodes.select("node", "sketch", "keys"), "node").select(*carried, "sketch", "keys")
    left = stored(together(rows).mapInArrow(members, ", ".join(f"{c} long" for c in carried)), "minhash-left")
    wanted = nodes.select("node", "th", "d1", "d2").join(left.select("node").distinct(), "node")
    sets = stored(_sets(docs, text, shingle, wanted), "minhash-sets")
    rows = left.join(nodes.select("node", "sketch"), "node").join(sets, "node").select(*carried, "sketch", "set")
    found = stored(together(rows).mapInArrow(links, "a long, b long").distinct(), "minhash-links")
    discard(met, left, sets)
    return found


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component, kept) for each row of ``docs``.

    Rows hang together if 100 times the shingles that two sets share is at least ``percent`` times those of both, step by
    step. ``component`` is the smallest key of all that are reached, ``kept`` whether it is the row's own. Rows of equal
    sets are one node. Null and empty texts, and those of blanks alone, have no shingles and hang with nothing: their
    component is their own key. Null keys are never the smallest unless a group has no other. Repeated rows stay rows,
    all kept or none. An empty table gives an empty one.
    """
    marks = stored(_marks(docs, key, text, shingle), "minhash-marks")
    sets = marks.where("n > 0").groupBy("d1", "d2")
    firsts = [F.any_value(c).alias(c) for c in ("n", "keys", "sketch")]
    nodes = sets.agg(F.min("key").alias("least"), F.min("th").alias("th"), *firsts)
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")

    postings = nodes.select("node", F.explode("keys").alias("key"))
    shared = stored(postings.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key"), "minhash-buckets")
    postings = stored(postings.join(shared, "key"), "minhash-postings")
    labels, tried = nodes.select("node", F.col("node").alias("part")), None
    for turn in range(STARS + 1):
        named, mixed = _mixed_buckets(postings, labels, turn)
        if mixed.isEmpty():
            break
        if turn < STARS:
            found = _stars(named, mixed)
            if tried is not None:
                found = found.join(tried, ["a", "b"], "left_anti")
            found = stored(found, "minhash-candidates")
            tried = found if tried is None else tried.union(found)
            links = _confirmed(_plausible(found, nodes, percent), nodes, docs, text, shingle, percent)
        else:
            links = _left_over(named, mixed, nodes, docs, text, shingle, percent)
        discard(named, mixed)
        # Parts that a link joins become one; the rest of the graph need not be gone through again.
        between = links.join(labels.select(F.col("node").alias("a"), F.col("part").alias("x")), "a")
        between = between.join(labels.select(F.col("node").alias("b"), F.col("part").alias("y")), "b").select("x", "y")
        joined = stored(connected_components(between, "x", "y"), "minhash-joined").withColumnRenamed("node", "part")
        older, labels = labels, stored(labels.join(joined, "part", "left").select("node", F.coalesce("component", "part").alias("part")), "minhash-labels")
        discard(older, links)

    placed = nodes.join(labels, "node").select("d1", "d2", "least", "part")
    placed = stored(placed, "minhash-placed")
    smallest = stored(placed.groupBy("part").agg(F.min("least").alias("component")), "minhash-smallest")
    placed = stored(placed.join(smallest, "part").select("d1", "d2", "component"), "minhash-named")
    held = marks.where("n > 0").select("key", "n", "d1", "d2").join(placed, ["d1", "d2"]).select("key", "n", "component")
    rows = held.union(marks.where("n = 0").select("key", "n", "key"))
    return rows.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "component", F.col("key").eqNullSafe(F.col("component")).alias("kept")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 85) -> DataFrame:
    """``docs``, all its columns, with those rows that ``components`` keeps; keys tell rows apart.

    Rows of one key with different texts stay if any of them is kept. Rows of a null key stay.
    """
    renamed, back = aside(docs, *ADDED)
    kept = components(renamed, key, text, shingle, percent).where("kept").select(F.col(f"`{key}`").alias("_mh_row")).distinct()
    kept = stored(kept, "minhash-kept")
    rows = renamed.join(kept, renamed[key] == kept["_mh_row"], "left_semi").unionByName(renamed.where(F.col(f"`{key}`").isNull()))
    return rows.withColumnsRenamed(back).select(*[f"`{c}`" for c in docs.columns])
