"""Language-model scores by prediction by partial matching over bytes, beside a unigram base over words.

The model is a trie of byte contexts up to four bytes long with the symbol after each, learned from all training
texts. A text is padded with four begin bytes and ends with an end byte; neither occurs in UTF-8. The probability
of a symbol goes from the longest context that training has seen down to the empty one. At each, the escape is
estimated as the number of distinct symbols over that number plus all counts (method C), and the symbols of the longer
context are excluded. What is left after the empty context is shared equally by the symbols never seen.

A node's successors in the longer context are a subset of those in the shorter one, so the excluded counts are sums
over the trie's own entries and no symbol is walked one by one. Entries are five bytes (context and symbol); their two
middle bytes, the end of the context, choose the shard of the trie that holds all contexts of two bytes and
more of a chain. Contexts of one byte and none are a table of 256 x 256 counts that every shard gets.

Texts are dealt over blocks. A block asks each shard for its distinct entries and words and brings along its training
counts; a shard sums the counts of all blocks, evaluates each asked entry, and answers. Then the block's texts are
summed. So the corpus is counted whole, and what moves is the distinct entries of blocks, packed in arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from wardstat.llm import bytescan
from wardstat.llm.common import Shared, chunks, sql_type, stored, text_of

U = np.uint64
BEGIN, END = 0xFE, 0xFF
#: Bytes that can follow a context: all but the begin byte.
SYMBOLS = 255
#: Text bytes of a block, and blocks at most; beyond that, blocks grow, and with them what a task holds, which is
#: the distinct entries of a block and never its texts.
BLOCK_BYTES = 32 << 20
MOST_BLOCKS = 8192
#: Stands for the end of a text among the hashes of words.
END_WORD = U(0x9D1F0A6B5C3E7785)
#: Entries that wait before they are summed.
WAITING = 2_000_000


def entries_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The five-byte entry of each predicted symbol, the end included, and where those of each text begin."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.full(len(data) + 5 * n, BEGIN, np.uint8)
    symbol = np.ones(len(padded), bool)
    start = offsets[:-1] + 5 * np.arange(n)
    for k in range(4):
        symbol[start + k] = False
    padded[start + 4 + size] = END
    inner = symbol.copy()
    inner[start + 4 + size] = False
    padded[inner] = data
    wide = padded.astype(np.int64)
    out = wide[4:].copy()
    for k in range(1, 5):
        out |= wide[4 - k : len(wide) - k] << (8 * k)
    return out[symbol[4:]], start - 4 * np.arange(n)


class Tally:
    """Distinct keys and their counts; a key may count 0."""

    def __init__(self, dtype: type):
        self.keys, self.counts = [np.zeros(0, dtype)], [np.zeros(0, np.int64)]
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | int) -> None:
        self.keys.append(keys)
        self.counts.append(np.broadcast_to(np.asarray(counts, np.int64), keys.shape))
        self.waiting += len(keys)
        if self.waiting > WAITING + 2 * len(self.keys[0]):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > 1:
            keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, np.concatenate(self.counts))
            self.keys, self.counts, self.waiting = [keys], [counts], 0
        return self.keys[0], self.counts[0]


def pack(numbers: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(numbers).tobytes(), 1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack(packed: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype)


def unpack_sorted(packed: bytes, dtype: str) -> np.ndarray:
    steps = unpack(packed, dtype)
    return np.cumsum(steps, dtype=steps.dtype)


def gram_shard(entries: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((((entries >> 8) & 0xFFFF).astype(U) * bytescan.P1) >> U(40)).astype(np.int64) % shards


def word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    return (words >> U(40)).astype(np.int64) % shards


def ask(block: int, grams: Tally, words: Tally, shards: int) -> Iterator[tuple]:
    """What a block asks of each shard, as (shard, block, entries, counts, words, counts)."""
    parts = []
    for tally, shard_of in ((grams, gram_shard), (words, word_shard)):
        keys, counts = tally.total()
        shard = shard_of(keys, shards)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        parts.append((keys[order], counts[order], cut))
    for s in range(shards):
        own = [(k[cut[s] : cut[s + 1]], n[cut[s] : cut[s + 1]]) for k, n, cut in parts]
        if any(len(k) for k, _ in own):
            yield (s, block, *(x for k, n in own for x in (pack_sorted(k), pack(n))))


class Trie:
    """One shard: the entries of training and what follows from them for every context."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray, pairs: np.ndarray):
        self.orders = []
        keys, n = entries, counts
        for order in (4, 3, 2):
            head = np.flatnonzero(np.diff(keys >> 8, prepend=-1))
            self.orders.append({"keys": keys, "n": n, "contexts": keys[head] >> 8, "head": head})
            keys, at = np.unique(keys & ((1 << (8 * order)) - 1), return_inverse=True)
            n = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
        empty = pairs.sum(axis=0)
        seen = pairs > 0
        for k, o in enumerate(self.orders):
            o["total"] = np.add.reduceat(o["n"], o["head"]) if len(o["head"]) else np.zeros(0, np.int64)
            o["distinct"] = np.diff(np.append(o["head"], len(o["keys"])))
            # Counts that this context's symbols have in the next shorter one.
            if k < 2:
                shorter = self.orders[k + 1]
                below = shorter["n"][np.searchsorted(shorter["keys"], o["keys"] & ((1 << (8 * (4 - k))) - 1))]
            else:
                below = pairs[(o["keys"] >> 8) & 0xFF, o["keys"] & 0xFF]
            o["excluded"] = np.add.reduceat(below, o["head"]) if len(o["head"]) else np.zeros(0, np.int64)
        self.one = {"n": pairs, "total": pairs.sum(axis=1), "distinct": seen.sum(axis=1), "excluded": (seen * empty).sum(axis=1)}
        self.none = {"n": empty, "total": empty.sum(), "distinct": (empty > 0).sum()}

    def log10(self, entries: np.ndarray) -> np.ndarray:
        """The log10 probability of each entry's symbol after its context."""
        out = np.zeros(len(entries))
        todo = np.arange(len(entries))
        gone, used = np.zeros(len(entries), np.int64), np.zeros(len(entries), np.int64)
        for k in range(5):
            asked = entries[todo]
            if k < 3:
                o = self.orders[k]
                key = asked & ((1 << (8 * (5 - k))) - 1)
                n = _at(o["keys"], o["n"], key)
                total, distinct, excluded = (_at(o["contexts"], o[c], key >> 8) for c in ("total", "distinct", "excluded"))
            elif k == 3:
                last, symbol = (asked >> 8) & 0xFF, asked & 0xFF
                n = self.one["n"][last, symbol]
                total, distinct, excluded = (self.one[c][last] for c in ("total", "distinct", "excluded"))
            else:
                n = self.none["n"][asked & 0xFF]
                total, distinct = (np.full(len(asked), self.none[c]) for c in ("total", "distinct"))
                excluded = np.zeros(len(asked), np.int64)
            left, fresh = total - gone, distinct - used
            room = left + fresh
            hit = n > 0
            out[todo[hit]] += np.log10(n[hit] / room[hit])
            missed = ~hit
            escape = missed & (room > 0)
            out[todo[escape]] += np.log10(fresh[escape] / room[escape])
            todo, gone, used = todo[missed], excluded[missed], distinct[missed]
        out[todo] -= np.log10(max(1, SYMBOLS - int(self.none["distinct"])))
        return out


def _at(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked key, 0 where it isn't there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


ASKED = "shard int, block int, entries binary, entry_n binary, words binary, word_n binary"
ANSWERED = "block int, entries binary, logs binary, words binary, word_n binary, known long"


def _ask_all(docs: DataFrame, shards: int) -> DataFrame:
    """Per block its questions, and under shard -1 its counts of byte pairs and its training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, grams, words, tokens = None, None, None, 0

        def done() -> Iterator[pa.RecordBatch]:
            keys, n = grams.total()
            pairs = np.bincount(keys & 0xFFFF, weights=n, minlength=1 << 16).astype(np.int64)
            some = np.flatnonzero(pairs)
            rows = [(-1, block, pack(some), pack(pairs[some]), b"", tokens.to_bytes(8, "little")), *ask(block, grams, words, shards)]
            for row in rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row))], schema)

        names = [c.split()[0] for c in ASKED.split(", ")]
        schema = pa.schema([(c, pa.int32() if i < 2 else pa.binary()) for i, c in enumerate(names)])
        for part in _by_block(chunks(batches)):
            own = part.column("block")[0].as_py()
            if own != block:
                if block is not None:
                    yield from done()
                block, grams, words, tokens = own, Tally(np.int64), Tally(U), 0
            trained = ~part.column("held_out").to_numpy(zero_copy_only=False)
            data, offsets = bytescan.raw(part.column("text"))
            entries, start = entries_of(data, offsets)
            w = bytescan.words(data, offsets, lower=True)
            hashes = bytescan.xxh64(w.data, w.start, w.end - w.start)
            learns = np.repeat(trained, np.diff(np.append(start, len(entries))))
            for tally, keys, used in ((grams, entries, learns), (words, hashes, trained[w.doc])):
                tally.add(*np.unique(keys[used], return_counts=True))
                tally.add(np.unique(keys[~used]), 0)
            words.add(np.array([END_WORD]), int(trained.sum()))
            tokens += int(trained[w.doc].sum() + trained.sum())
        if block is not None:
            yield from done()

    return docs.repartition("block").sortWithinPartitions("block").mapInArrow(run, ASKED)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut where the block changes."""
    for batch in batches:
        block = batch.column("block").to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        yield from (batch.slice(a, b - a) for a, b in zip(cut, cut[1:]) if b > a)


def _answer_all(asked: DataFrame, pairs: Shared) -> DataFrame:
    """Each shard's answers to each block, and under block -1 how many distinct words training has there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pairs.load()
        names = [c.split()[0] for c in ANSWERED.split(", ")]
        kinds = [pa.int32(), *[pa.binary()] * 4, pa.int64()]
        shard, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            grams, words = Tally(np.int64), Tally(U)
            for r in rows:
                grams.add(unpack_sorted(r["entries"], "<i8"), unpack(r["entry_n"], "<i8"))
                words.add(unpack_sorted(r["words"], "<u8"), unpack(r["word_n"], "<i8"))
            keys, n = grams.total()
            trie = Trie(keys[n > 0], n[n > 0], table)
            known, known_n = words.total()
            out = [(-1, b"", b"", b"", b"", int((known_n > 0).sum()))]
            for r in rows:
                logs = trie.log10(unpack_sorted(r["entries"], "<i8")).astype("<f4")
                counts = known_n[np.searchsorted(known, unpack_sorted(r["words"], "<u8"))]
                out.append((r["block"], r["entries"], pack(logs), r["words"], pack(counts), 0))
            for row in out:
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    if shard is not None:
                        yield from done()
                    shard, rows = r["shard"], []
                rows.append(r)
        if shard is not None:
            yield from done()

    return asked.where("shard >= 0").repartition("shard").sortWithinPartitions("shard").mapInArrow(run, ANSWERED)


def _sum_up(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """Per text the tokens, the known ones, the sum of log10(count + 1) and the log10 probability."""
    kind = sql_type(docs, "key")
    schema = StructType(
        [
            StructField("key", kind),
            StructField("held_out", BooleanType()),
            StructField("n_tokens", LongType()),
            StructField("n_known", LongType()),
            StructField("logs", DoubleType()),
            StructField("score", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], False
        grams = words = logs = counts = None
        for part in _by_block(chunks(batches)):
            own = part.column("block")[0].as_py()
            if own != block:
                block, held, ready = own, [], False
            answer = part.column("answer").to_numpy(zero_copy_only=False)
            if answer.any():
                held.extend(part.filter(pa.array(answer)).select(["entries", "logs", "words", "word_n"]).to_pylist())
                part = part.filter(pa.array(~answer))
            if not part.num_rows:
                continue
            if not ready:
                join = lambda of, dtype: np.concatenate([np.zeros(0, dtype), *(of(r) for r in held)])
                grams = bytescan.Lookup(join(lambda r: unpack_sorted(r["entries"], "<i8"), np.int64))
                logs = join(lambda r: unpack(r["logs"], "<f4"), np.float64)
                words = bytescan.Lookup(join(lambda r: unpack_sorted(r["words"], "<u8"), U))
                counts = join(lambda r: unpack(r["word_n"], "<i8"), np.int64)
                held, ready = [], True
            data, offsets = bytescan.raw(part.column("text"))
            entries, start = entries_of(data, offsets)
            score = np.add.reduceat(logs[grams.find(entries)], start)
            w = bytescan.words(data, offsets, lower=True)
            hashes = bytescan.xxh64(w.data, w.start, w.end - w.start)
            # Every text has one end more than words.
            texts = np.arange(part.num_rows)
            doc = np.append(w.doc, texts)
            n = counts[words.find(np.append(hashes, np.full(part.num_rows, END_WORD)))]
            out = [
                np.bincount(doc, minlength=part.num_rows),
                np.bincount(doc, weights=n > 0, minlength=part.num_rows).astype(np.int64),
                np.bincount(doc, weights=np.log10(n + 1.0), minlength=part.num_rows),
                score,
            ]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("held_out"), *map(pa.array, out)], schema.names)

    both = docs.withColumn("answer", F.lit(False)).unionByName(
        answers.where("block >= 0").withColumn("answer", F.lit(True)), allowMissingColumns=True
    )
    both = both.withColumn("text", F.coalesce("text", F.lit("")))
    return both.repartition("block").sortWithinPartitions("block", F.col("answer").desc()).mapInArrow(run, schema)


def score(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; ``held_out`` is a column expression
    that tells the rows the model doesn't learn from.

    Null and empty texts consist of the end alone. Null and repeated keys stay rows; equal rows share a block. Without
    any training text all symbols are equally likely. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), held_out.alias("held_out"), text_of(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, min(MOST_BLOCKS, -(-size // BLOCK_BYTES)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)).cast("int"))
    asked = stored(_ask_all(rows, max(12, blocks)), "asked")
    pairs, tokens = _pairs(asked)
    answers = stored(_answer_all(asked, Shared(spark, pairs)), "answers")
    distinct = answers.where("block < 0").agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    # Counts plus one over all tokens plus one for each distinct token and one for all the others.
    room = F.log10(F.lit(float(tokens + distinct + 1)))
    return _sum_up(rows, answers).select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * room).alias("base_score"),
        "score",
    )


def _pairs(asked: DataFrame) -> tuple[np.ndarray, int]:
    """Counts of a byte after a byte, 65,536 at most, and the number of training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                # The tokens come as one more pair.
                pair = np.append(unpack(r["entries"], "<i8"), 1 << 16)
                n = np.append(unpack(r["entry_n"], "<i8"), int.from_bytes(r["word_n"], "little"))
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    counts = asked.where("shard < 0").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table, tokens = np.zeros(1 << 16, np.int64), 0
    for pair, n in counts.collect():
        if pair < 1 << 16:
            table[pair] = n
        else:
            tokens = n
    return table.reshape(256, 256), tokens
