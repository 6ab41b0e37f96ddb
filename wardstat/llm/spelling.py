"""Spelling variants: words that one edit turns into each other, through an index of grams of variable length.

Every word is cut into grams: at each place the longest one of a dictionary that starts there, unless an earlier gram
covers it. The dictionary extends a gram by a character only where the gram is frequent, so common beginnings get long
grams and rare ones short. For each word a bound says how many of its grams one edit can affect; all others are found in
the variant too, at the same distance from the front or from the back. A word therefore looks only into the lists of
its rarest grams, one more than the bound. Those who meet in a list are verified.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm import bytescan
from wardstat.llm.cells import dealt, pairs, whole
from wardstat.llm.common import Shared, chunks, stored, text_of

U = np.uint64
#: Text bytes whose words are counted together before the shuffle.
COUNTED_BYTES = 4 << 20
#: A run of letters loses a character where this divides its checksum.
DAMAGED = 199
#: Shortest and longest grams. Words of fewer than twice as many characters have no longest ones, so that an edit never
#: affects all grams of a word.
SHORTEST, LONGEST = 2, 5
LEAST_LENGTH = 2 * SHORTEST + 2
#: Grams that the dictionary extends, per length, at most: those with a larger share of all places than one in so many.
EXTENDED = 20_000
#: Members of a list that are compared in one cell with as many others.
CELL = 4096
#: Words up to this length are compared as rows of one matrix; a pair with a longer one by itself.
WIDTH = 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def checksums(data: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of data[start[i] : start[i] + size[i]] that goes on from the checksum ``before``."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    crc = ~before[order].astype(np.uint32)
    for k in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -k, side="left"))
        crc[:live] = CRC[(crc[:live] ^ data[at[:live] + k]) & np.uint32(255)] ^ (crc[:live] >> np.uint32(8))
    out = np.empty(len(crc), np.uint32)
    out[order] = ~crc
    return out


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, bytes, characters and text of each maximal run of A-Z, a-z and U+00C0 to U+00FF in UTF-8."""
    lead = data == 0xC3
    tail = np.zeros(len(data), bool)
    tail[1:] = lead[:-1]
    lower = data | 32
    letter = ((lower >= 97) & (lower <= 122) & (data < 128)) | lead | tail
    # Texts begin where a run must not go on from the text before.
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] |= letter[begins]
    inner = begins[begins > 0]
    last[inner - 1] |= letter[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    tails = np.concatenate([[0], np.cumsum(tail)])
    size = end - start
    return start, size, size - (tails[end] - tails[start]), np.searchsorted(offsets, start, side="right") - 1


def count_words(keys: list[str], texts: pa.Array, damaged: int = DAMAGED, least: int = LEAST_LENGTH) -> dict[str, int]:
    """How often each word of at least ``least`` characters occurs in the texts, after damage by key and word."""
    data, offsets = bytescan.raw(texts)
    start, size, length, doc = _runs(data, offsets)
    long = length >= least
    start, size, length, doc = start[long], size[long], length[long], doc[long]
    data = bytescan.LOWER[data]
    heads = np.array([zlib.crc32(f"{k}:".encode()) for k in keys], np.uint32)
    crc = checksums(data, start, size, heads[doc] if len(doc) else np.zeros(0, np.uint32))
    hurt = crc % damaged == 0
    out: dict[str, int] = {}
    held = data.tobytes()
    for i in np.flatnonzero(hurt).tolist():
        word = held[start[i] : start[i] + size[i]].decode()
        at = int(crc[i]) % len(word)
        word = word[:at] + word[at + 1 :]
        if len(word) >= least:
            out[word] = out.get(word, 0) + 1
    start, size = start[~hurt], size[~hurt]
    _, one, n = np.unique(bytescan.xxh64(data, start, size), return_index=True, return_counts=True)
    for a, b, c in zip(start[one].tolist(), (start[one] + size[one]).tolist(), n.tolist()):
        word = held[a:b].decode()
        out[word] = out.get(word, 0) + c
    return out


def vocabulary(docs: DataFrame, key: str, text: str, least_count: int) -> DataFrame:
    """(word, n): the words that occur ``least_count`` times or more in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", COUNTED_BYTES):
            counts = count_words(part.column("key").to_pylist(), part.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), text_of(text).alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Counts of the grams that hold more than one in EXTENDED of all places; fewer than EXTENDED of each length."""
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    grams = F.expr(
        f"flatten(transform(sequence({SHORTEST}, {LONGEST}), q -> transform(sequence(1, length(word) - q + 1), p -> substring(word, p, q))))"
    )
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return dict(map(tuple, counts.where(F.col("n") > places / EXTENDED).collect()))


def grams_of(word: str, frequent: dict[str, int], longest: int) -> list[tuple[str, int]]:
    """The grams of a word and their places: the longest of the dictionary at each place, if no earlier one covers it."""
    out, covered = [], 0
    for place in range(len(word) - SHORTEST + 1):
        end = place + SHORTEST
        while end < min(len(word), place + longest) and word[place:end] in frequent:
            end += 1
        if end > covered:
            out.append((word[place:end], place))
            covered = end
    return out


def most_affected(grams: list[tuple[str, int]], length: int, longest: int) -> int:
    """How many of a word's grams one edit can affect.

    A gram stays if it ends so far before the edit that no longer gram reaches it from its place, or begins behind the
    edit and ends where no gram from before the edit can cover it.
    """
    ends = [(place, place + len(gram)) for gram, place in grams]
    kept = len(grams)
    for at in range(length + 1):
        # An inserted character before ``at``; then a changed or deleted one at ``at``.
        kept = min(kept, sum(p + longest <= at or (p >= at and e >= at + longest) for p, e in ends))
        if at < length:
            kept = min(kept, sum(p + longest <= at or (p > at and e > at + longest) for p, e in ends))
    return len(grams) - kept


def list_keys(word: str, frequent: dict[str, int]) -> Iterator[tuple[str, bool]]:
    """(list, whether the word is the longer one there). Words meet in the class of the shorter one's length."""
    for shorter in (len(word), len(word) - 1):
        if shorter < LEAST_LENGTH:
            continue
        longest = min(LONGEST, shorter // 2)
        grams = grams_of(word, frequent, longest)
        rarest = sorted(grams, key=lambda g: (frequent.get(g[0], 0), g))[: most_affected(grams, len(word), longest) + 1]
        for gram, place in rarest:
            yield f"{shorter} {place} {gram}", len(word) > shorter
            yield f"{shorter} -{len(word) - place} {gram}", len(word) > shorter


def postings(words: DataFrame, spark: SparkSession) -> DataFrame:
    """(key, longer, word, n): the lists that each word looks into."""
    held = Shared(spark, frequent_grams(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = held.load()
        for batch in batches:
            row, keys, longer = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                for key, long in list_keys(word, frequent):
                    row.append(i)
                    keys.append(key)
                    longer.append(long)
            own = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(longer, pa.bool_()), *own.columns], ["list", "longer", "word", "n"])

    rows = words.select("word", "n").mapInArrow(run, "list string, longer boolean, word string, n long")
    return rows.select(F.xxhash64("list").alias("key"), "longer", "word", "n")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def near_pairs(held: np.ndarray, size: np.ndarray, words: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) are one edit apart; ``held`` has the first WIDTH characters of each word, then zeros."""
    near = np.zeros(len(i), bool)
    fits = np.maximum(size[i], size[j]) <= WIDTH
    # Pairs of equal length: the characters that differ.
    same = np.flatnonzero((size[i] == size[j]) & fits)
    near[same] = (held[i[same]] != held[j[same]]).sum(axis=1) == 1
    # One is longer: from the first difference on it goes on one place later.
    other = np.flatnonzero((abs(size[i] - size[j]) == 1) & fits)
    flip = size[i[other]] > size[j[other]]
    short = held[np.where(flip, j[other], i[other])]
    long = held[np.where(flip, i[other], j[other])]
    first = (short != long).argmax(axis=1)
    later = short[:, : WIDTH - 1] != long[:, 1:]
    last = np.where(later.any(axis=1), WIDTH - 2 - later[:, ::-1].argmax(axis=1), -1)
    near[other] = last < first
    for k in np.flatnonzero(~fits).tolist():
        near[k] = one_edit(words[i[k]], words[j[k]])
    return near


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for each word and each that is one edit away, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begins in whole(batches):
            own, longer = rows.column("own").to_numpy(), rows.column("longer").to_numpy(zero_copy_only=False)
            apart = rows.column("low").to_numpy() != rows.column("high").to_numpy()
            texts = rows.column("word").to_pylist()
            # All characters are below U+0100.
            held = np.array([w.encode("latin-1") for w in texts], f"S{WIDTH}").view(np.uint8).reshape(-1, WIDTH)
            size = pc.utf8_length(rows.column("word")).to_numpy()
            marks = np.bitwise_or.reduce(np.where(held > 0, U(1) << (held & 63).astype(U), U(0)), axis=1)
            for i, j in pairs(begins, rows.num_rows, 1 << 18):
                # Two longer ones meet in their own class. One edit changes at most two of the characters that occur.
                fit = ~(longer[i] & longer[j]) & (~apart[i] | (own[i] != own[j])) & (np.bitwise_count(marks[i] ^ marks[j]) <= 2)
                i, j = i[fit], j[fit]
                found = near_pairs(held, size, texts, i, j) if len(i) else fit[:0]
                i, j = i[found], j[found]
                one, other = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
                word, n = rows.column("word"), rows.column("n")
                yield pa.RecordBatch.from_arrays([word.take(one), word.take(other), n.take(other)], ["word", "near", "near_n"])

    # Spark sizes the lists by the words' file, though each word gives dozens: their join is told to shuffle.
    lists = postings(words, words.sparkSession).hint("merge")
    return dealt(lists, CELL, "longer").mapInArrow(run, "word string, near string, near_n long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last one when forms are followed. Each step doubles its length.

    Packed files tell little of the memory that a row per word takes, so these joins are told to shuffle.
    """
    held = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        held = stored(held.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not held.where("moved").take(1):
            return held.select("word", "root")
        held = held.drop("moved")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_count: int = 5, factor: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of six characters or more that occurs often enough.

    Words are runs of Latin letters (A-Z, a-z and U+00C0 to U+00FF), A-Z in lower case. ``n_near`` counts the words one
    edit away; ``form`` is the most frequent of them (ties: the smallest in code-point order) if it occurs ``factor``
    times as often as the word, else null; ``root`` is where following forms ends, the word itself if it has none. Null
    and empty texts have no words; a null key counts as the empty text. Rows that repeat count each time. No words give an
    empty table.
    """
    words = stored(vocabulary(docs, key, text, least_count), "spelling-words")
    near = near_words(words)
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    found = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    is_form = F.col("best.near_n") >= factor * F.col("n")
    joined = words.join(found.hint("merge"), "word", "left").select(
        "word",
        F.when(is_form, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near_n")).alias("form_n"),
    )
    joined = stored(joined, "spelling-forms")
    ends = roots(joined.where("form is not null"))
    return joined.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
