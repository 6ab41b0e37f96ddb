"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their beginnings of four and five characters, in lower case, as 64-bit hashes. Fitted on a
bounded sample of labelled rows: the terms whose texts are toxic far more often than others, their document frequencies, and the TF-IDF vectors of the sample over these terms. The sample is the only thing that is bounded;
every text is scored as a whole. The index holds the weights of each term by example, in blocks of
examples with the greatest weight of each term; a query goes through blocks in the order of their upper bounds
until no block can reach the k-th best similarity, so the neighbours are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from wardstat.llm import bytescan
from wardstat.llm.common import Shared, chunks, fresh, sql_type, stored, text_of

U = np.uint64
#: Labelled texts that the index is fitted on, give or take chance; those of least hash when there are more.
SAMPLE_ROWS = 20_000
#: Terms of the index at most, those of strongest evidence.
MOST_TERMS = 50_000
#: Terms by pure chance that the selection may let in, and the least share of toxic ones among texts with a term.
CHANCE_TERMS = 0.01
LEAST_SHARE = 0.6
BEGINNINGS = (4, 5)
NEIGHBOURS = 15
BLOCK = 64
#: A neighbour's vote weighs its cosine to this power; the prior has a vote of this weight.
CLOSENESS = 4
PRIOR_WEIGHT = 0.02
#: Columns that score adds; those of ``docs`` with these names are replaced.
ADDED = ("_score", "_toxic", "_evidence")
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Terms(NamedTuple):
    doc: np.ndarray
    term: np.ndarray
    count: np.ndarray


def _hashes(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The text of each word and, by kind, the hashes of its terms; 0 where a word has no such beginning."""
    data, offsets = bytescan.raw(texts)
    letter = LETTER[data]
    first = np.empty(len(data), bool)
    first[1:] = ~letter[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    last = np.empty(len(data), bool)
    last[:-1] = ~letter[1:]
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    start, end = np.flatnonzero(first & letter), np.flatnonzero(last & letter) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    out = [bytescan.xxh64(data, start, end - start, seed=1)]
    points = np.append(np.flatnonzero((data & 0xC0) != 0x80), np.full(max(BEGINNINGS), len(data)))
    rank = np.searchsorted(points, start)
    for n in BEGINNINGS:
        cut = points[np.minimum(rank + n, len(points) - 1)]
        long = cut <= end
        h = np.zeros(len(start), U)
        h[long] = bytescan.xxh64(data, start[long], (cut - start)[long], seed=n)
        out.append(h)
    return doc, out


def terms_of(texts: pa.Array, known: "Index | None" = None) -> Terms:
    """The distinct terms of each text with their counts, of ``known`` terms only if given. Term 0 is none."""
    doc, hashes = _hashes(texts)
    docs, found = [], []
    for h in hashes:
        here = np.flatnonzero(known.may_have(h) if known else h != 0)
        docs.append(doc[here])
        found.append(h[here])
    d, t = np.concatenate(docs), np.concatenate(found)
    if known:
        place = known.place(t)
        d, t = d[place >= 0], place[place >= 0]
    order = np.lexsort((t, d))
    d, t = d[order], t[order]
    head = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))) if len(d) else np.zeros(0, np.int64)
    return Terms(d[head], t[head], np.diff(np.append(head, len(d))))


class Index:
    """Selected terms with their inverse document frequency, and the labelled examples that have any."""

    SIEVE = 1 << 20

    def __init__(self, terms: np.ndarray, idf: np.ndarray, prior: float):
        order = np.argsort(terms)
        self.terms, self.idf, self.prior = terms[order], idf[order], prior
        self.sieve = np.zeros(self.SIEVE, bool)
        self.sieve[(self.terms & U(self.SIEVE - 1)).astype(np.int64)] = True
        self.ids: list = []
        self.labels = np.zeros(0)
        self.head = np.zeros(len(terms) + 1, np.int64)

    def may_have(self, h: np.ndarray) -> np.ndarray:
        return self.sieve[(h & U(self.SIEVE - 1)).astype(np.int64)]

    def place(self, h: np.ndarray) -> np.ndarray:
        """The number of each term, or -1."""
        if not len(self.terms):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def weights(self, found: Terms) -> np.ndarray:
        """TF-IDF weights, of length one for each text."""
        w = (1 + np.log(found.count)) * self.idf[found.term]
        return w / np.sqrt(np.bincount(found.doc, weights=w * w))[found.doc] if len(w) else w

    def add(self, vectors: list[tuple[object, int, list[int], list[int]]]) -> None:
        """Index examples (id, label, term numbers, counts). Like examples get near numbers, so that few blocks
        have a large greatest weight."""
        vectors = sorted((v for v in vectors if v[2]), key=lambda v: (sorted(v[2]), str(v[0])))
        self.ids = [v[0] for v in vectors]
        self.labels = np.array([v[1] for v in vectors], float)
        size = [len(v[2]) for v in vectors]
        doc = np.repeat(np.arange(len(vectors)), size)
        term = np.array([t for v in vectors for t in v[2]], np.int64)
        count = np.array([n for v in vectors for n in v[3]], np.int64)
        weight = self.weights(Terms(doc, term, count)) if len(doc) else np.zeros(0)
        order = np.lexsort((doc, term))
        self.doc, self.weight, term = doc[order], weight[order], term[order]
        self.head = np.searchsorted(term, np.arange(len(self.terms) + 1))
        block = self.doc // BLOCK
        begin = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if len(term) else np.zeros(0, np.int64)
        self.block = block[begin]
        self.greatest = np.maximum.reduceat(self.weight, begin) if len(begin) else np.zeros(0)
        self.block_from = np.append(begin, len(term))
        self.block_head = np.searchsorted(begin, self.head)
        self.blocks = -(-len(vectors) // BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above zero, best first; of equals those of lower number."""
        spans = [(self.block_head[t], self.block_head[t + 1]) for t in terms]
        bound = np.zeros(self.blocks)
        for (a, b), w in zip(spans, weights):
            bound[self.block[a:b]] += w * self.greatest[a:b]
        best, names = np.zeros(0), np.zeros(0, np.int64)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        for step in range(0, len(order), 8):
            some = order[step : step + 8]
            if len(best) == k and bound[some[0]] < best[-1] - 1e-12:
                break
            score = np.zeros((len(some), BLOCK))
            where = np.full(self.blocks, -1)
            where[some] = np.arange(len(some))
            for (a, b), w in zip(spans, weights):
                for j in np.flatnonzero(where[self.block[a:b]] >= 0) + a:
                    rows = slice(self.block_from[j], self.block_from[j + 1])
                    score[where[self.block[j]], self.doc[rows] % BLOCK] += w * self.weight[rows]
            i, j = np.nonzero(score)
            best = np.concatenate([best, score[i, j]])
            names = np.concatenate([names, some[i] * BLOCK + j])
            top = np.lexsort((names, -best))[:k]
            best, names = best[top], names[top]
        return names, best

    def score(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[float, np.ndarray, np.ndarray]:
        """The votes of the nearest, weighed by closeness, with the prior as one more vote; the neighbours."""
        names, near = self.nearest(terms, weights, k)
        votes = near**CLOSENESS
        total = float(votes.sum())
        toxic = float((votes * self.labels[names]).sum()) if len(names) else 0.0
        return (toxic + PRIOR_WEIGHT * self.prior) / (total + PRIOR_WEIGHT), names, near


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS
) -> Index:
    """An index of about ``sample_rows`` labelled texts at most, those of least hash of the key.

    Keys without a label or a text don't count; a key with several labels has the greatest, one with several texts any
    of them. Without any row, or with one label only, no term is selected and the prior is all there is.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key"))
    known = known.agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
    unit = F.shiftrightunsigned(F.xxhash64("key"), 11) * F.lit(2.0**-53)
    chosen = known.where(unit < sample_rows / max(1, known.count()))
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.lower(text_of(text)).alias("text"))
    # The chosen keys are as many as the sample has rows, whatever the tables hold.
    sample = texts.join(F.broadcast(chosen), "key").dropDuplicates(["key"]).select("key", "label", "text")
    return _fit(spark, stored(sample, "labelled"))


def _fit(spark: SparkSession, sample: DataFrame) -> Index:
    count, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < count:
        return _empty(toxic / count if count else 0.0)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            found = terms_of(part.column("text"))
            label = part.column("label").to_numpy()[found.doc]
            term, at = np.unique(found.term, return_inverse=True)
            n = np.bincount(at, minlength=len(term)), np.bincount(at, weights=label, minlength=len(term)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), *map(pa.array, n)], ["term", "n", "bad"])

    share = toxic / count
    tallied = stored(sample.select("label", "text").mapInArrow(tally, "term long, n long, bad long"), "terms")
    tallied = tallied.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n > 1")
    # The chance of so many toxic texts is at most exp(-n * divergence); terms tested bound what chance lets in.
    p, clean = F.col("bad") / F.col("n"), F.col("n") - F.col("bad")
    divergence = F.col("bad") * F.log(p / share) + F.when(clean > 0, clean * F.log((1 - p) / (1 - share))).otherwise(0.0)
    least = math.log(max(1, tallied.count()) / CHANCE_TERMS)
    chosen = (
        tallied.where((p >= max(LEAST_SHARE, share)) & (divergence >= least))
        .orderBy(divergence.desc(), "term").limit(MOST_TERMS).collect()
    )
    terms = np.array([r["term"] for r in chosen], np.int64).view(U)
    index = Index(terms, np.log((1 + count) / (1 + np.array([r["n"] for r in chosen], float))) + 1, 0.0)
    held = Shared(spark, index)
    kind = sql_type(sample, "key")
    schema = StructType(
        [StructField("key", kind), StructField("label", IntegerType()), StructField("terms", ArrayType(LongType())), StructField("counts", ArrayType(LongType()))]
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.load()
        for part in chunks(batches):
            found = terms_of(part.column("text"), known)
            cut = np.searchsorted(found.doc, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int64))) for x in (found.term, found.count)]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("label"), *lists], schema.names)

    rows = sample.mapInArrow(vectors, schema).collect()
    index.add([(r["key"], r["label"], r["terms"], r["counts"]) for r in rows])
    # What texts without any selected term come to.
    bare = [r["label"] for r in rows if not r["terms"]]
    index.prior = (sum(bare) + share) / (len(bare) + 1)
    return index


def _empty(prior: float) -> Index:
    index = Index(np.zeros(0, U), np.zeros(0), prior)
    index.add([])
    return index


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text", threshold: float = 0.3, evidence: bool = False) -> DataFrame:
    """``docs`` (all columns) with ``_score`` and ``_toxic`` (score at least ``threshold``), and on request ``_evidence``:
    the keys of the nearest examples. Texts without a selected term, also null and empty ones, get the prior."""
    held = Shared(docs.sparkSession, index)
    columns = [c for c in docs.columns if c.lower() not in ADDED]
    plain = fresh([*columns, *ADDED], "_text")
    fields = [*(docs.schema[c] for c in columns), StructField("_score", DoubleType()), StructField("_toxic", BooleanType())]
    if evidence:
        fields.append(StructField("_evidence", ArrayType(sql_type(docs, key))))
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.load()
        for part in chunks(batches, plain):
            found = terms_of(part.column(plain), index)
            weights = index.weights(found)
            scores = np.full(part.num_rows, index.prior)
            near: list = [[] for _ in range(part.num_rows)]
            cut = np.searchsorted(found.doc, np.arange(part.num_rows + 1))
            for i in np.flatnonzero(np.diff(cut)):
                own = slice(cut[i], cut[i + 1])
                scores[i], names, _ = index.score(found.term[own], weights[own])
                if evidence:
                    near[i] = [index.ids[j] for j in names]
            out = [*(part.column(c) for c in columns), pa.array(scores), pa.array(scores >= threshold)]
            if evidence:
                out.append(pa.array(near, pa.list_(part.column(key).type)))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return docs.select(*(f"`{c}`" for c in columns), F.lower(text_of(text)).alias(plain)).mapInArrow(run, schema)
