"""Byte-level BPE with public ranks: encoding in length-bucketed padded numpy matrices, decoding, digests.

A text falls into units at each single space between two other characters; the pattern has a boundary there
whatever stands around. Each distinct unit of a chunk is split by the pattern once, each distinct piece is
encoded once. Pieces of about the same length share a padded matrix of token ids: every round finds the
leftmost pair of least rank in each row by one hashed lookup of all pairs, merges it and closes the gap, until no
row has a pair with a rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from wardstat.llm import bytescan
from wardstat.llm.common import Shared, chunks, sql_type, text_of

NONE = np.int64(1) << 40
#: Bytes up to which a piece goes to the matrix of that width; longer ones double the width each time.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32)
#: Cells of one matrix.
CELLS = 1 << 14
#: Units of the current and of the last generation that a worker remembers; beyond that a new one begins.
REMEMBERED = 150_000
#: Text bytes that are encoded at once.
ENCODED_BYTES = 2 << 20
WHITE = np.zeros(256, bool)
WHITE[[*range(9, 14), *range(28, 33)]] = True
# White space beyond ASCII, in UTF-8.
WIDE_WHITE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def spread(blob: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen pieces of ``blob``, which holds pieces of the given sizes, one after another."""
    own = size[chosen]
    shift = (np.cumsum(size) - size)[chosen] - (np.cumsum(own) - own)
    return blob[np.repeat(shift, own) + np.arange(int(own.sum()))]


class Vocabulary:
    """The ranks of a file, as bytes by id and as an open-addressing table from pairs of ids to the merged id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        # The decimal of each id with a comma.
        decimals = [b"%d," % i for i in range(len(self.bytes))]
        self.decimals = np.frombuffer(b"".join(decimals), np.uint8)
        self.digits = np.array([len(x) for x in decimals], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = bytescan.Lookup(np.array(left, np.int64) << 32 | np.array(right, np.int64))
        # The last place is for pairs without a rank.
        self.merged = np.array([*merged, NONE], np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, or NONE."""
        return self.merged[self.pairs.find(left << 32 | right)]

    def merge_matrix(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ids, of which the first ``size`` count, merged to the end."""
        done_ids, done_size = np.empty_like(ids), np.empty_like(size)
        row = np.arange(len(ids))
        place = np.arange(ids.shape[1])
        ranks = np.full(ids.shape, NONE)
        inside = place[:-1] + 1 < size[:, None]
        ranks[:, :-1][inside] = self.ranks_of(ids[:, :-1][inside], ids[:, 1:][inside])
        while len(ids):
            best = ranks.argmin(axis=1)
            least = ranks[np.arange(len(ids)), best]
            over = least == NONE
            if over.any():
                done_ids[row[over]], done_size[row[over]] = ids[over], size[over]
                ids, size, ranks, row, best, least = (x[~over] for x in (ids, size, ranks, row, best, least))
                if not len(ids):
                    break
            n = np.arange(len(ids))
            ids[n, best] = least
            gap = place[:-1] > best[:, None]
            np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=gap)
            np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=gap)
            size = size - 1
            ranks[:, -1] = NONE
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.ranks_of(ids[left, best[left] - 1], ids[left, best[left]])
            right = best + 1 < size
            ranks[n[~right], best[~right]] = NONE
            right = n[right]
            ranks[right, best[right]] = self.ranks_of(ids[right, best[right]], ids[right, best[right] + 1])
        return done_ids, done_size

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one piece after another, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        widths = [1, *WIDTHS]
        while len(sizes) and widths[-1] < sizes.max():
            widths.append(2 * widths[-1])
        bucket = np.searchsorted(widths, sizes)
        order = np.argsort(bucket, kind="stable")
        count, found = np.zeros(len(sizes), np.int64), [np.zeros(0, np.int64)]
        for k in np.unique(bucket):
            own = order[np.searchsorted(bucket[order], k) : np.searchsorted(bucket[order], k, side="right")]
            width = widths[k]
            rows = max(1, CELLS // width)
            for i in range(0, len(own), rows):
                part = own[i : i + rows]
                size = sizes[part]
                ids = np.zeros((len(part), width), np.int64)
                inside = np.arange(width) < size[:, None]
                ids[inside] = self.byte_ids[np.frombuffer(b"".join([pieces[j] for j in part]), np.uint8)]
                ids, size = self.merge_matrix(ids, size) if width > 1 else (ids, size)
                count[part] = size
                found.append(ids[np.arange(width) < size[:, None]])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return spread(np.concatenate(found), count[order], back), count

    def decode(self, ids: np.ndarray) -> bytes:
        return spread(self.blob, self.size, ids).tobytes()


def read_ranks(path: str) -> Vocabulary:
    """The vocabulary of a rank file: per line a token in base64 and its rank."""
    with open(path, "rb") as file:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: at each text and at each single space between characters other than white space."""
    white = WHITE[data]
    if len(data) > 2 and (data >= 0xC2).any():
        for lead in WIDE_WHITE:
            at = np.flatnonzero(data[: len(data) - len(lead) + 1] == lead[0])
            for k in range(1, len(lead)):
                at = at[data[at + k] == lead[k]]
            for k in range(len(lead)):
                white[at + k] = True
    begin = np.zeros(len(data) + 1, bool)
    begin[1 : len(data) - 1] = (data[1:-1] == 32) & ~white[:-2] & ~white[2:] if len(data) > 2 else False
    # A space that ends one text, or that begins the next, has its neighbour in another text.
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edge - 1] = False
    begin[offsets] = True
    return np.flatnonzero(begin[:-1])


class Encoder:
    """Encodes texts by a vocabulary and a split pattern. For recent units it remembers the ids, as decimals with
    a comma after each, and the bytes that these ids decode to."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.ids: dict[bytes, bytes] = {}
        self.decoded: dict[bytes, bytes] = {}
        self.older = (self.ids, self.decoded)

    def learn(self, fresh: list[bytes]) -> None:
        """Encode units. Those that begin with a single space and end in another character are split by the
        pattern together, since it has a boundary before each of them; the others one by one."""
        texts = [u.decode() for u in fresh]
        plain = [t[0] == " " and len(t) > 1 and not t[1].isspace() and not t[-1].isspace() for t in texts]
        together = "".join([t for t, p in zip(texts, plain) if p])
        alone = [t for t, p in zip(texts, plain) if not p]
        fresh = [u for u, p in zip(fresh, plain) if p] + [u for u, p in zip(fresh, plain) if not p]
        pieces = [p.encode() for p in self.pattern.findall(together)]
        pieces += [p.encode() for t in alone for p in self.pattern.findall(t)]
        number = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        ids, count = self.vocabulary.encode_pieces(list(number))
        chosen = np.array([number[p] for p in pieces], np.int64)
        ids, count = spread(ids, count, chosen), count[chosen]
        # Where the ids of each unit end: after the piece that ends with the unit.
        ends = np.searchsorted(np.cumsum([len(p) for p in pieces]), np.cumsum([len(u) for u in fresh]))
        ends = np.cumsum(count)[ends] if len(fresh) else ends
        v = self.vocabulary
        for known, blob, size in ((self.ids, v.decimals, v.digits), (self.decoded, v.blob, v.size)):
            held = spread(blob, size, ids).tobytes()
            to = np.concatenate([[0], np.cumsum(size[ids])])[ends].tolist()
            known.update(zip(fresh, [held[a:b] for a, b in zip([0, *to], to)]))

    def recall(self, distinct: list[bytes]) -> None:
        """Encode those of the distinct units that are not remembered."""
        if len(self.ids) > REMEMBERED:
            self.older = (self.ids, self.decoded)
            self.ids, self.decoded = {}, {}
        ids, decoded = self.older
        fresh = []
        for u in distinct:
            if u not in self.ids:
                if u in ids:
                    self.ids[u], self.decoded[u] = ids[u], decoded[u]
                else:
                    fresh.append(u)
        self.learn(fresh)

    def encode(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """The ids of each text, as decimals joined by commas, and the bytes they decode to."""
        data, offsets = bytescan.raw(texts)
        start = unit_starts(data, offsets)
        end = np.append(start[1:], len(data))
        _, first, unit = np.unique(bytescan.xxh64(data, start, end - start), return_index=True, return_inverse=True)
        held = data.tobytes()
        distinct = [held[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
        self.recall(distinct)
        cut = np.searchsorted(start, offsets)
        outcome = []
        for known in (self.ids, self.decoded):
            own = [known[u] for u in distinct]
            size = np.array([len(x) for x in own], np.int64)
            joined = spread(np.frombuffer(b"".join(own), np.uint8), size, unit).tobytes()
            outcome.append((joined, np.concatenate([[0], np.cumsum(size[unit])])[cut].tolist()))
        (ids, at), (decoded, to) = outcome
        if decoded != held:
            raise ValueError("two units of a chunk share a hash, or the vocabulary lacks a byte")
        for i in range(len(texts)):
            yield ids[at[i] : at[i + 1]][:-1], decoded[to[i] : to[i + 1]]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) per row, with the ids themselves on request.

    The digests are of the decimal ids joined by commas and of the bytes that the ids decode to, in lower-case
    hex. Null and empty texts have no ids and the digests of nothing; null and repeated keys stay rows.
    The driver reads ``path`` and broadcasts the vocabulary, which is as large as that file allows.
    """
    return _encoded(docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("text")), path, pattern, with_ids).withColumnRenamed("key", key)


def _encoded(docs: DataFrame, path: str, pattern: str, with_ids: bool) -> DataFrame:
    fields = [
        StructField("key", sql_type(docs, "key")),
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    if with_ids:
        fields.append(StructField("ids", BinaryType()))

    held = Shared(docs.sparkSession, read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.load(), pattern)
        for part in chunks(batches, limit=ENCODED_BYTES):
            count, ids_hash, bytes_hash, packed = [], [], [], []
            for ids, decoded in encoder.encode(part.column("text")):
                count.append(ids.count(b",") + 1 if ids else 0)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                bytes_hash.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    packed.append(np.array(ids.split(b",") if ids else [], "<u4").tobytes())
            out = [part.column("key"), pa.array(count, pa.int64()), pa.array(ids_hash), pa.array(bytes_hash)]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                out.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.mapInArrow(run, StructType(fields))
