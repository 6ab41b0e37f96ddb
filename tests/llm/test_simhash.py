from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import pairs_of
from wardstat.llm import bytescan, simhash


def fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components(pairs, bits=4):
    """The smallest key reachable, per (key, fingerprint)."""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for key, f in pairs:
        if key is not None:
            least[root(f)].append(key)
    return {f: min(least[root(f)], default=None) for f in fps}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab Cé\t\n.", max_size=60), max_size=6), st.integers(1, 5))
def test_fingerprints_equal_plain_python(texts, n):
    got = simhash.fingerprints_of(pa.array(texts, pa.string()), n)
    assert got.tolist() == [fingerprint(t, n) for t in texts]


def test_hash_equals_the_library_at_every_length():
    data = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    sizes = np.arange(300)
    assert bytescan.xxh64(data, sizes, sizes).tolist() == [xxhash.xxh64_intdigest(data[n : 2 * n].tobytes(), 42) for n in sizes]


def test_long_text_counts_do_not_overflow():
    text = "a b c d e " * 30_000
    assert simhash.fingerprints_of(pa.array([text]))[0] == fingerprint(text)


def test_positions_cover_every_minimum_of_matches():
    from itertools import combinations

    for bits in range(8):
        chosen = [set(c) for c in simhash.covering_positions(bits)]
        assert all(any(c <= set(s) for c in chosen) for s in combinations(range(8), 8 - bits))


def test_links_join_what_brute_force_joins(spark, monkeypatch):
    """Random balls of fingerprints, also with lists longer than a cell and than the short ones."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12)
    fps = {0} | {int(c) ^ sum(1 << int(b) for b in rng.integers(0, 63, rng.integers(0, 7))) for c in centres for _ in range(40)}
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    for cell in (simhash.CELL, 8):
        monkeypatch.setattr(simhash, "CELL", cell)
        links = {(r["a"], r["b"]) for r in simhash.fingerprint_links(nodes, 4).collect()}
        parent = {f: f for f in fps}

        def root(f):
            while parent[f] != f:
                f = parent[f]
            return f

        for a, b in links:
            parent[max(root(a), root(b))] = min(root(a), root(b))
        expected = components([(f, f) for f in fps])
        assert {f: root(f) for f in fps} == expected


def test_components_on_all_kinds_of_rows(docs, empty):
    rows = pairs_of(docs)
    found = simhash.near_duplicates(docs)
    got = Counter((r["doc_id"], r["text"], r["_fp"] % 2**64, r["_component"]) for r in found.collect())
    marked = [(k, fingerprint(t)) for k, t in rows]
    least = components(marked)
    assert got == Counter((k, t, f, least[f]) for (k, t), (_, f) in zip(rows, marked))
    assert set(docs.columns) < set(found.columns)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # A key with two texts can be the least of two groups.
    assert set(ids) == set(least.values()) and len(ids) == found.select("_part").distinct().count()
    assert simhash.near_duplicates(empty).count() == simhash.keep_one(empty).count() == 0
