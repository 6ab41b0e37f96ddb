"""Vectorised words and hashes over the UTF-8 bytes of many texts at once.

A chunk of texts is one byte array with offsets, as Arrow keeps it. Words are runs of bytes other than
the six ASCII blanks (space, tab, line feed, vertical tab, form feed, carriage return).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64
# The constants of XXH64.
P1, P2, P3, P4, P5 = (
    U(0x9E3779B185EBCA87),
    U(0xC2B2AE3D27D4EB4F),
    U(0x165667B19E3779F9),
    U(0x85EBCA77C2B2AE63),
    U(0x27D4EB2F165667C5),
)


class Words(NamedTuple):
    """``data``: bytes with every gap between words cut to one space; word i is data[start[i]:end[i]] of text doc[i]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; nulls are empty."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    if lower:
        data = LOWER[data]
    blank = BLANK[data]
    first = np.empty(len(data), bool)
    first[1:] = blank[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    last = np.empty(len(data), bool)
    last[:-1] = blank[1:]
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    start = np.flatnonzero(first & ~blank)
    end = np.flatnonzero(last & ~blank)
    doc = np.searchsorted(offsets, start, side="right") - 1
    kept = ~(blank & first)
    place = np.cumsum(kept)
    return Words(np.where(blank, np.uint8(32), data)[kept], place[start] - 1, place[end], doc)


def windows(w: Words, n: int) -> np.ndarray:
    """The first words of all windows of n words within a text."""
    if len(w.doc) < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(w.doc[: len(w.doc) - n + 1] == w.doc[n - 1 :])


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U(bits)) | (x >> U(64 - bits))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(state + lane * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[start[i] : start[i] + size[i]] for every i, as unsigned numbers."""
    if not len(start):
        return np.zeros(0, U)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))
    fours = np.ndarray((len(data) - 3,), "<u4", data.data, strides=(1,))
    seed = U(seed)
    with np.errstate(over="ignore"):
        out = np.full(len(start), seed + P5, U)
        long = np.flatnonzero(size >= 32)
        if len(long):
            long = long[np.argsort(-(size[long] >> 5), kind="stable")]
            stripes, at = size[long] >> 5, start[long]
            lanes = [np.full(len(long), x, U) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            # Longest first, so the spans that still have a stripe are a head of the array.
            for r in range(int(stripes[0])):
                live = int(np.searchsorted(-stripes, -r, side="left"))
                for k, lane in enumerate(lanes):
                    lane[:live] = _round(lane[:live], eights[at[:live] + (32 * r + 8 * k)])
            mixed = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                mixed = (mixed ^ _round(U(0), lane)) * P1 + P4
            out[long] = mixed
        out += size.astype(U)
        at, rest = start + (size & ~31), size & 31
        for k in (8, 16, 24):
            i = np.flatnonzero(rest >= k)
            out[i] = _turn(out[i] ^ _round(U(0), eights[at[i] + k - 8]), 27) * P1 + P4
        at, rest = at + (rest & ~7), rest & 7
        i = np.flatnonzero(rest >= 4)
        out[i] = _turn(out[i] ^ (fours[at[i]].astype(U) * P1), 23) * P2 + P3
        at, rest = at + (rest & 4), rest & 3
        for k in (1, 2, 3):
            i = np.flatnonzero(rest >= k)
            out[i] = _turn(out[i] ^ (data[at[i] + k - 1].astype(U) * P5), 11) * P1
        out = (out ^ (out >> U(33))) * P2
        out = (out ^ (out >> U(29))) * P3
        return out ^ (out >> U(32))


def rolling(hashes: np.ndarray, heads: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of the n word hashes from each head on."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(heads), U)
        for k in range(n):
            out = out * P3 + hashes[heads + k]
        return (out ^ (out >> U(29))) * P1


class Lookup:
    """Distinct 64-bit numbers, none of them the largest, by open addressing: the place of each asked number or -1."""

    EMPTY = U(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray):
        keys = keys.astype(U)
        self.bits = max(4, int(np.ceil(np.log2(3 * len(keys) + 3))))
        self.keys = np.full(1 << self.bits, self.EMPTY)
        self.places = np.full(1 << self.bits, -1, np.int64)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):  # of all that want a free slot the last written stays; the others go on to the next
            free = todo[self.keys[at[todo]] == self.EMPTY]
            self.keys[at[free]] = keys[free]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
        self.places[at] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * P1) >> U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(U)
        at = self._slot(keys)
        found = self.keys[at]
        todo = np.flatnonzero((found != keys) & (found != self.EMPTY))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[at[todo]]
            todo = todo[(found != keys[todo]) & (found != self.EMPTY)]
        return self.places[at]
