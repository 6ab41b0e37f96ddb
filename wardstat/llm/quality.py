"""Repetition coverage and simple counts per text, on hashed words in numpy.

Words are runs of characters other than the six ASCII blanks. A chunk of texts is hashed at once; windows of
n words get a rolling hash of their word hashes, and those that a text holds twice or more are found by one sort.
Coverage of n is the share of a text's word characters inside such windows. Line coverage is the share of its
word characters in lines equal to an earlier line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from wardstat.llm import bytescan
from wardstat.llm.common import chunks, sql_type, text_of

U = np.uint64
#: Highest share of a text's word characters inside its duplicated n-grams, by n, and in its duplicated lines.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.10
#: Word characters that a text of any length may have there beyond its share: a heading that comes again at the end, both
#: times. So the limit falls smoothly from the short texts, of which a heading is much, to the share of the long ones.
ALLOWED = 100
LEAST_WORDS = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _repeated(keys: np.ndarray, doc: np.ndarray, later: bool = False) -> np.ndarray:
    """Which keys their text holds twice or more; with ``later`` without the first of each."""
    with np.errstate(over="ignore"):
        keys = (keys ^ (doc.astype(U) * bytescan.P5)) * bytescan.P1
    order = np.argsort(keys, kind="stable" if later else None)
    ranked = keys[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    out = np.zeros(len(keys), bool)
    out[order[same + 1]] = True
    if not later:
        out[order[same]] = True
    return out


def _covered(heads: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words are in one of the windows of n words that begin at the heads."""
    step = np.zeros(total + 1, np.int32)
    step[heads] += 1
    step[heads + n] -= 1
    return np.cumsum(step[:-1]) > 0


def measure(texts: pa.Array, lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> dict[str, np.ndarray]:
    """The counts and coverages of each text."""
    data, offsets = bytescan.raw(texts)
    w = bytescan.words(data, offsets)
    n = len(texts)
    blank = bytescan.BLANK[data]
    letter = ~blank & ((data & 0xC0) != 0x80)
    letters_to = np.concatenate([[0], np.cumsum(letter)])
    symbols_to = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    word_chars = letters_to[offsets[1:]] - letters_to[offsets[:-1]]
    out = {
        "n_words": np.bincount(w.doc, minlength=n),
        "word_chars": word_chars,
        "n_symbols": symbols_to[offsets[1:]] - symbols_to[offsets[:-1]],
    }
    share = np.maximum(word_chars, 1)

    starts = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    starts = starts[starts < len(data)]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), offsets[doc + 1])
    ends = ends - ((ends > starts) & (data[ends - 1] == 10))
    chars = letters_to[ends] - letters_to[starts]
    full = chars > 0
    starts, ends, doc, chars = starts[full], ends[full], doc[full], chars[full]
    later = _repeated(bytescan.xxh64(data, starts, ends - starts), doc, later=True)
    out["n_dup_lines"] = np.bincount(doc[later], minlength=n)
    out["line_chars"] = np.bincount(doc[later], weights=chars[later], minlength=n)
    out["line_coverage"] = out["line_chars"] / share

    hashes = bytescan.xxh64(w.data, w.start, w.end - w.start)
    begins = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    size = begins[w.end] - begins[w.start]
    heads = bytescan.windows(w, 3)
    any_of = _repeated(bytescan.rolling(hashes, heads, 3), w.doc[heads])
    out["n_repeat_words"] = np.bincount(w.doc[_covered(heads[any_of], 3, len(w.doc))], minlength=n)
    for k in lengths:
        heads = bytescan.windows(w, k)
        any_of = _repeated(bytescan.rolling(hashes, heads, k), w.doc[heads])
        covered = _covered(heads[any_of], k, len(w.doc))
        out[f"chars_{k}"] = np.bincount(w.doc[covered], weights=size[covered], minlength=n)
        out[f"coverage_{k}"] = out[f"chars_{k}"] / share
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ngram_limits: dict[int, float] | None = None,
    line_limit: float = LINE_LIMIT,
    least_words: int = LEAST_WORDS,
    allowed: int = ALLOWED,
) -> DataFrame:
    """(key, the five counts, base_failed, line_coverage, coverage_n ..., kept) per row.

    ``base_failed``: fewer than ``least_words`` words, or over half of them in repeated 3-word windows. ``kept``: not
    that, and the characters of every coverage within the limit's share of all and ``allowed`` more. Null, empty and blank
    texts have zeros and fail; texts of any length are measured whole. A coverage just at its limit is within it. Null and
    repeated keys stay rows; other columns don't matter. An empty table gives an empty one.
    """
    limits = NGRAM_LIMITS if ngram_limits is None else ngram_limits
    shares = ["line_coverage", *(f"coverage_{n}" for n in limits)]
    fields = [StructField("key", sql_type(docs, key))]
    fields += [StructField(c, LongType()) for c in COUNTS]
    fields += [StructField("base_failed", BooleanType())]
    fields += [StructField(c, DoubleType()) for c in shares]
    fields += [StructField("kept", BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            m = measure(part.column("text"), tuple(limits))
            failed = (m["n_words"] < least_words) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
            kept = ~failed & (m["line_chars"] <= line_limit * m["word_chars"] + allowed)
            for n, limit in limits.items():
                kept &= m[f"chars_{n}"] <= limit * m["word_chars"] + allowed
            out = [*(m[c].astype(np.int64) for c in COUNTS), failed, *(m[c] for c in shares), kept]
            yield pa.RecordBatch.from_arrays([part.column("key"), *map(pa.array, out)], [f.name for f in fields])

    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(run, StructType(fields)).withColumnRenamed("key", key)
