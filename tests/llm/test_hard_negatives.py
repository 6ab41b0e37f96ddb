import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF
from wardstat.llm import hard_negatives
from wardstat.llm.common import table
from wardstat.llm.queries import QUERIES

SCHEMA = "id long, label long, vector array<long>, anchor_id string, score int"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    width = max(len(v) for _, _, v in rows)
    x = np.array([list(v) + [0] * (width - len(v)) for _, _, v in rows], object)
    out = []
    anchors = {}
    for i, (k, label, v) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[1][2])):
        if k % 100 == 0:
            anchors.setdefault(k, i)
    for k, i in anchors.items():
        scores = x @ x[i]
        order = sorted((j for j in range(len(rows)) if rows[j][0] != k), key=lambda j: (-scores[j], rows[j][0]))
        for p in [j for j in order if rows[j][1] == rows[i][1]][:positives]:
            fit = [j for j in order if rows[j][1] != rows[i][1] and low * scores[p] <= 100 * scores[j] <= high * scores[p]]
            out += [(k, rows[p][0], r, rows[j][0], scores[p], scores[j]) for r, j in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.mine(df, F.col("id") % 100 == 0, **settings)
    return sorted(map(tuple, found.collect()))


@pytest.fixture
def rows():
    rng = np.random.default_rng(4)
    centres = rng.integers(-60, 60, (12, 6))
    x = centres[rng.integers(0, 12, 900)] + rng.integers(-15, 15, (900, 6))
    x[100:160] = x[100]  # a common vector: ties
    out = [(i, int(rng.integers(0, 4)), [int(c) for c in v]) for i, v in enumerate(x)]
    return out + [out[100], out[200], (300, 9, [1, 2, 3]), (901, 1, []), (902, 2, [0] * 6)]


def test_equals_brute_force(spark, rows, monkeypatch):
    want = plain(rows)
    assert len(want) > 200
    monkeypatch.setattr(hard_negatives, "BLOCK", 130)
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    monkeypatch.setattr(hard_negatives, "FANOUT", 3)
    monkeypatch.setattr(hard_negatives, "GROUP", 3)
    assert mined(spark, rows) == want


def test_other_windows_and_large_components(spark, rows):
    assert mined(spark, rows, positives=2, negatives=3, low=0, high=100) == plain(rows, 2, 3, 0, 100)
    large = [(k, label, [c << 20 for c in v]) for k, label, v in rows[:300]]
    assert mined(spark, large) == plain(large)


def test_nulls_and_empty_tables(spark, rows):
    odd = [(None, 1, [1, 2]), (1000, None, [1, 2]), (1001, 1, None), (1002, 1, [1, None])]
    assert mined(spark, rows[:250] + odd) == plain(rows[:250])
    assert mined(spark, []) == [] and mined(spark, odd) == []
    assert mined(spark, [(0, 1, [5, 5])]) == [] and mined(spark, [(0, 1, []), (1, 1, []), (2, 2, [])]) == plain([(0, 1, []), (1, 1, []), (2, 2, [])])


def test_boxes_hold_all_rows_and_bounds_prune():
    rng = np.random.default_rng(6)
    x = rng.integers(-100, 100, (3000, 3))
    labels = rng.integers(0, 3, 3000)
    tree = hard_negatives.pack(np.arange(3000), labels, x)
    low, high, least, most = tree.levels[0]
    assert sorted(tree.ids.tolist()) == list(range(3000)) and (least == most).all()
    for n in range(len(low)):
        own = tree.rows[tree.begins[n] : tree.begins[n + 1]]
        assert len(own) <= hard_negatives.LEAF and (own >= low[n]).all() and (own <= high[n]).all()
    assert (tree.levels[-1][0][0] == x.min(axis=0)).all() and len(tree.levels[-1][0]) == 1
    # Three coordinates: a search for the best reads few leaves.
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at)
            return super().__getitem__(at)

    one = hard_negatives.Anchors(np.array([-1]), np.array([1]), x[:1], np.array([0]), np.array([-(1 << 62)]), np.array([1 << 62]))
    at, ids, scores = hard_negatives.search(tree._replace(rows=tree.rows.view(Counted)), one, 5, True)
    want = sorted(((-int(x[i] @ x[0]), i) for i in np.flatnonzero(labels == 1)))[:5]
    assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want
    assert len(read) < len(low) / 3


def test_query_drops_odd_vectors(spark, tmp_path):
    given = table(spark, SF, "embeddings").limit(120)
    odd = [(5000, [float("nan")] * 2, 1), (5001, [float("inf"), 1.0], 1), (5002, [None, 1.0], 1), (5003, None, 1), (5004, [1.0, 1.0], None)]
    both = given.unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int"))
    for name, df in (("plain", given), ("odd", both)):
        df.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    a, b = (sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, f"{tmp_path}/{n}").collect())) for n in ("plain", "odd"))
    assert a == b and a
