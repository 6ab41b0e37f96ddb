"""Benchmark items inside documents: MinHash containment by item size, verified on exact shingles.

A short item in a long document has a Jaccard similarity near nothing, so sketches of whole documents cannot find
it; containment must be searched from the item's side. Items are partitioned by their number of shingles. An item's
sketch is its k least shingle hashes, k set for each size partition such that a document which holds the wanted
share of an item of that size cannot miss all k of them: sketches let no item slip. Every shingle of every
document probes the sketches; the share of an item's sketch that is met estimates its containment; documents with
too few shingles for a size partition are not candidates of it; candidates are verified on the shingles themselves.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from wardstat.llm import bytescan
from wardstat.llm.common import Shared, chunks, fresh, sql_type, text_of

U = np.uint64
#: Text bytes of the items that go over the documents together; a larger benchmark takes several passes.
PASS_BYTES = 32 << 20
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of ASCII letters, digits and all other bytes above ASCII. Per shingle of n words: its text and
    hash; then the bytes with one space between words and the begin and end of each shingle."""
    data, offsets = bytescan.raw(texts)
    w = bytescan.words(np.where(LETTER[data], data, np.uint8(32)), offsets)
    head = bytescan.windows(w, n)
    start, end = w.start[head], w.end[head + n - 1]
    return w.doc[head], bytescan.xxh64(w.data, start, end - start, seed=n), w.data, start, end


class Items:
    """Sketches and shingles of items, for one shingle length."""

    def __init__(self, keys: list, texts: list[str], n: int, share: float):
        doc, hashes, data, start, end = shingles(pa.array(texts, pa.string()), n)
        held = data.tobytes()
        sets: dict[int, dict[int, bytes]] = defaultdict(dict)
        for i, h, a, b in zip(doc.tolist(), hashes.tolist(), start.tolist(), end.tolist()):
            sets[i][h] = held[a:b]
        self.n, self.share = n, share
        self.keys = [keys[i] for i in sets]
        self.shingles = [set(s.values()) for s in sets.values()]
        # Size partitions double; sizes within one share the number of minima that its largest needs.
        partition = [math.ceil(math.log2(len(s))) for s in self.shingles]
        minima = [math.floor((1 - share) * 2**p + 1e-9) + 1 for p in partition]
        self.least = np.array([math.ceil(share * len(s) - 1e-9) for s in self.shingles], np.int64)
        self.sketch_size = np.array([min(k, len(s)) for k, s in zip(minima, sets.values())], np.int64)
        pairs = sorted((h, i) for i, (s, k) in enumerate(zip(sets.values(), self.sketch_size)) for h in sorted(s)[:k])
        hashes = np.array([h for h, _ in pairs], U)
        self.owner = np.array([i for _, i in pairs], np.int64)
        self.lookup = bytescan.Lookup(np.unique(hashes))
        self.cut = np.searchsorted(hashes, np.append(np.unique(hashes), U(0xFFFFFFFFFFFFFFFF)))

    def candidates(self, doc: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) pairs whose sketch is met often enough: a document with the wanted share of an item lacks
        at most the rest of its shingles, so at most as many minima."""
        place = self.lookup.find(hashes)
        here = np.flatnonzero(place >= 0)
        if not len(here):
            return
        met = np.unique(np.stack([doc[here], place[here]], axis=1), axis=0)
        size = np.diff(self.cut)[met[:, 1]]
        d = np.repeat(met[:, 0], size)
        first = np.repeat(self.cut[met[:, 1]] - (np.cumsum(size) - size), size)
        item = self.owner[first + np.arange(len(d))]
        pair, n = np.unique(np.stack([d, item], axis=1), axis=0, return_counts=True)
        total = np.bincount(doc)
        lacking = np.array([len(s) for s in self.shingles])[pair[:, 1]] - self.least[pair[:, 1]]
        enough = (n >= self.sketch_size[pair[:, 1]] - lacking) & (total[pair[:, 0]] >= self.least[pair[:, 1]])
        yield from pair[enough].tolist()

    def contained(self, texts: pa.Array) -> Iterator[tuple[int, int, float]]:
        """(text, item, share) for each item with at least the wanted share of its shingles in the text."""
        doc, hashes, data, start, end = shingles(texts, self.n)
        held, own, at = b"", set(), -1
        for d, item in self.candidates(doc, hashes):
            if d != at:
                held = held or data.tobytes()
                a, b = np.searchsorted(doc, [d, d + 1])
                at, own = d, {held[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist())}
            share = len(self.shingles[item] & own) / len(self.shingles[item])
            if share >= self.share - 1e-9:
                yield d, item, share


def _passes(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The items in groups of bounded size, one group after another on the driver."""
    rows = benchmark.select(F.col(f"`{key}`").alias("key"), F.lower(text_of(text)).alias("text"))
    group, held = [], 0
    for r in rows.toLocalIterator():
        if group and held + len(r["text"]) > PASS_BYTES:
            yield group
            group, held = [], 0
        group.append((r["key"], r["text"]))
        held += 4 * len(r["text"])
    if group:
        yield group


def _held_items(spark: SparkSession, benchmark: DataFrame, key: str, text: str, shingle: int, share: float) -> Iterator[Shared]:
    """The items of each pass, by shingle length."""
    for group in _passes(benchmark, key, text):
        by_length = defaultdict(list)
        for item, content in group:
            data, offsets = bytescan.raw(pa.array([content]))
            count = len(bytescan.words(np.where(LETTER[data], data, np.uint8(32)), offsets).doc)
            if count:
                by_length[min(count, shingle)].append((item, content))
        yield Shared(spark, [Items(*map(list, zip(*items)), n, share) for n, items in sorted(by_length.items())])


def find_items(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    share: float = 0.8,
) -> DataFrame:
    """(key, item_key, containment) for each document that holds at least ``share`` of an item's distinct shingles.

    Words are compared in lower case and without punctuation. An item of fewer than ``shingle`` words has one
    shingle, all its words, and is found where they stand together. Items and documents without words, null ones too,
    are never found. Repeated rows on either side give repeated results; null keys stay null. The benchmark, not the
    documents, passes through the driver, in groups of PASS_BYTES.
    """
    kinds = sql_type(docs, key), sql_type(benchmark, item_key)
    out = StructType([StructField("key", kinds[0]), StructField("item", kinds[1]), StructField("containment", DoubleType())])
    found = spark.createDataFrame([], out)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.lower(text_of(text)).alias("text"))
    for held in _held_items(spark, benchmark, item_key, item_text, shingle, share):
        found = found.union(rows.mapInArrow(_probe(held, out), out))
    return found.toDF(key, item_key, "containment")


def _probe(held: Shared, out: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = held.load()
        for part in chunks(batches):
            rows, items, shares = [], [], []
            for group in groups:
                for row, item, share in group.contained(part.column("text")):
                    rows.append(row)
                    items.append(group.keys[item])
                    shares.append(share)
            if rows:
                keys = part.column("key").take(pa.array(rows))
                kind = pa.int64() if isinstance(out["item"].dataType, LongType) else None
                yield pa.RecordBatch.from_arrays([keys, pa.array(items, kind), pa.array(shares)], out.names)

    return run


def drop_contaminated(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    share: float = 0.8,
) -> DataFrame:
    """``docs`` without the rows that ``find_items`` would find an item in; a row passes or goes where it is read."""
    columns, schema, plain = docs.columns, docs.schema, fresh(docs.columns, "_lower")
    for held in _held_items(spark, benchmark, item_key, item_text, shingle, share):
        marked = docs.select("*", F.lower(text_of(text)).alias(plain))
        docs = marked.mapInArrow(_keep(held, columns, plain), schema)
    return docs


def _keep(held: Shared, columns: list[str], plain: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = held.load()
        for part in chunks(batches, plain):
            clean = np.ones(part.num_rows, bool)
            for group in groups:
                clean[[row for row, _, _ in group.contained(part.column(plain))]] = False
            yield part.select(columns).filter(pa.array(clean))

    return run
