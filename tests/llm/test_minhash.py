import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import SF, pairs_of, sentence
from wardstat.llm import minhash
from wardstat.llm.common import table
from wardstat.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain(rows, percent=85):
    """{(key, text): (set size, component)} by comparing all pairs that share a shingle."""
    sets = {(k, t): shingles(t) for k, t in set(rows)}
    parent = {x: x for x in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = defaultdict(lambda: defaultdict(int))
    holders = defaultdict(list)
    for x, own in sets.items():
        for s in own:
            for y in holders[s]:
                shared[x][y] += 1
            holders[s].append(x)
    for x, near in shared.items():
        for y, n in near.items():
            if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                parent[root(x)] = root(y)
    groups = defaultdict(list)
    for x in sets:
        groups[root(x)].append(x)
    out = {}
    for own in groups.values():
        keys = [k for k, _ in own if k is not None]
        for x in own:
            out[x] = (len(sets[x]), min(keys, default=None))
    return out


def check(docs):
    rows = pairs_of(docs)
    want = plain(rows)
    by_key = defaultdict(list)
    for (k, _), (n, c) in want.items():
        by_key[k].append((n, c, k == c))
    got = defaultdict(set)
    found = minhash.components(docs).collect()
    for r in found:
        got[r["doc_id"]].add((r["n_shingles"], r["component"], r["kept"]))
    assert len(found) == len(rows)
    assert {k: set(v) for k, v in by_key.items()} == dict(got)
    return want


def test_equals_brute_force_on_the_given_documents(spark):
    want = check(table(spark, SF, "documents"))
    assert sum(k != c for (k, _), (_, c) in want.items()) > 5


def test_families_of_near_copies(spark):
    """Chains, a centre that hangs with nobody, and copies near the bound on both sides."""
    rng = random.Random(7)
    rows, key = [], 0
    for n in (6, 7, 12, 40, 200, 900):
        for _ in range(6):
            words = sentence(rng, n).split(" ")
            for _ in range(8):
                other = list(words)
                for _ in range(rng.choice([0, 1, 1, 2, 3])):
                    at = rng.randrange(len(other))
                    other[at : at + 1] = rng.choice([[], ["new"], ["x", "y"]])
                rows.append((key := key + 1, " ".join(other)))
                if rng.random() < 0.5:
                    words = other
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = check(docs)
    assert len({c for _, c in want.values()}) < len(rows) * 0.8


def test_odd_rows_and_empty_tables(spark, docs, empty):
    found = {(r["doc_id"], r["n_shingles"], r["component"], r["kept"]) for r in minhash.components(docs).collect()}
    rows = pairs_of(docs)
    own = lambda k: (k, 0, k, True)
    assert {own(k) for k, t in rows if not shingles(t)} <= found and {own(None)} <= found
    assert minhash.components(empty).count() == 0
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    # The sample has repeated rows, and one key with two texts: both stay.
    want = {(k, t) for k, t in rows if k is None or any(f[0] == k and f[3] for f in found)}
    assert set(pairs_of(kept)) == want and minhash.keep_one(empty).count() == 0


def test_bins_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(3)
    for size, shared in ((7, 6), (50, 40), (3000, 2400)):
        agree = []
        for _ in range(60):
            h = rng.integers(0, 2**63, 2 * size - shared).astype(np.uint64) * np.uint64(2)
            a, b = np.sort(h[:size]), np.sort(h[size - shared :])
            m = minhash.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2)
            agree.append((m[0] == m[1]).mean())
        assert np.mean(agree) == pytest.approx(shared / (2 * size - shared), abs=0.02)


def test_one_shingle_fills_all_bins_and_none_stays_empty():
    doc, h = minhash.shingle_sets(pa.array(["A b", "", None, "a  b", "a b c d e f"]))
    assert doc.tolist() == [0, 3, 4, 4] and h[0] == h[1]
    m = minhash.sketches(doc, h, 5)
    assert (m[0] == h[0]).all() and (m[1:3] == 0).all() and (m[4] != 0).all()


def test_buckets_give_a_star_and_the_query_its_columns(spark):
    """A thousand documents of one bucket with nothing else in common stay apart; the candidates are no square."""
    found = QUERIES["op13_minhash_near_dedup"](spark, SF)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found.count() == table(spark, SF, "documents").count()


def by_key(found):
    return {r["doc_id"]: (r["n_shingles"], r["component"]) for r in found.collect()}


def test_families_just_below_the_bound_make_no_row_per_pair(spark, monkeypatch):
    """Texts of one wording, most of them not similar enough: what is stored on the way grows with the texts, not their pairs."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(600)]
    rows = []
    for i in range(240):
        own = list(base)
        for at in rng.sample(range(600), 6):
            own[at] = f"x{i}y{at}"
        rows.append((i, " ".join(own)))
    sizes = {}
    real = minhash.stored

    def stored(df, name):
        out = real(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash, "stored", stored)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_key(minhash.components(docs)) == {k: v for (k, _), v in plain(rows).items()}
    for name in ("minhash-candidates", "minhash-pairs", "minhash-links"):
        assert sizes.get(name, 0) <= minhash.CENTRES * len(rows), name


def test_links_of_a_cell_join_its_parts():
    sets = pa.array([[1, 2, 3, 4], [2, 3, 4, 5], [1, 2, 3, 4, 5], [9], [2, 3, 4, 5]], pa.list_(pa.int64()))
    i, j = np.triu_indices(5, 1)
    joined = minhash._Joined()
    found = minhash._joining(i, j, np.array([10, 11, 12, 13, 11]), sets, joined, 60)
    # Rows 1 and 4 are one part already, and the third link of 0, 1 and 2 joins nothing new.
    assert len(found) == 2 and len({joined.root(p) for p in (10, 11, 12)}) == 1 and joined.root(13) == 13
    assert minhash._joining(i, j, np.array([10, 11, 12, 13, 11]), sets, joined, 60) == []


@pytest.mark.parametrize("name, small", [("CELL", 40), ("CELL_SHINGLES", 2000)])
def test_cells_of_many_parts_find_the_same(spark, monkeypatch, name, small):
    monkeypatch.setattr(minhash, name, small)
    monkeypatch.setattr(minhash, "STARS", 0)
    rng = random.Random(13)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in rng.sample(range(60), rng.randrange(3)):
            own[at] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_key(minhash.components(docs)) == {k: v for (k, _), v in plain(rows).items()}
