import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import WORDS, pairs_of, sentence
from wardstat.llm import toxicity

BAD = ["vileword", "nastything", "lowlifes", "lowlifer"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        words = sentence(rng, rng.randrange(20, 60)).split()
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), int(bad)))
    rows += [(1000, None, 0), (1001, "", 0), (1002, "river", None), (None, "stone", 0), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)


@pytest.fixture(scope="module")
def index(labelled):
    return toxicity.fit(labelled.select("doc_id", "text"), labelled)


def test_held_out_accuracy(spark, index):
    rng = random.Random(12)
    rows = []
    for i in range(200):
        words = sentence(rng, 50).split()
        if i % 4 == 0:
            words[10] = rng.choice(["Vileword,", "NASTYTHING", "lowlifexyz"])
        rows.append((i, " ".join(words)))
    found = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), index, evidence=True).collect()
    assert all(r["_toxic"] == (r["doc_id"] % 4 == 0) and 0 <= r["_score"] <= 1 for r in found)
    assert all(r["_evidence"] and all(k % 5 == 0 for k in r["_evidence"]) for r in found if r["_toxic"])


def test_nearest_are_exact(index, monkeypatch):
    """Blocks are skipped without loss: the same neighbours and similarities as from all dot products."""
    dense = np.zeros((len(index.ids), len(index.terms)))
    for t in range(len(index.terms)):
        own = slice(index.head[t], index.head[t + 1])
        dense[index.doc[own], t] = index.weight[own]
    assert np.allclose((dense**2).sum(axis=1), 1)
    rng = np.random.default_rng(2)
    for _ in range(100):
        terms = rng.choice(len(index.terms), min(len(index.terms), int(rng.integers(1, 5))), replace=False)
        weights = rng.random(len(terms)) + 0.1
        names, near = index.nearest(terms, weights, 7)
        all_of = dense[:, terms] @ weights
        order = np.lexsort((np.arange(len(all_of)), -all_of.round(12)))[:7]
        assert np.allclose(near, all_of[order][all_of[order] > 0])


def test_terms_equal_plain_python():
    import re

    texts = ["the lowlife, the été naïveté", "", "a1 b2c3d4e5"]
    found = toxicity.terms_of(pa.array(texts))
    for i, t in enumerate(texts):
        words = re.findall(r"[^\W_]+", t)
        want = Counter(words) + Counter((4, w[:4]) for w in words if len(w) >= 4) + Counter((5, w[:5]) for w in words if len(w) >= 5)
        assert sorted(found.count[found.doc == i].tolist()) == sorted(want.values())


def test_rows_of_all_kinds_and_degenerate_labels(docs, empty, labelled, index):
    found = toxicity.score(docs, index)
    assert Counter((r["doc_id"], r["text"]) for r in found.collect()) == Counter(pairs_of(docs))
    blank = found.where("trim(coalesce(text, '')) = ''").select("_score").distinct().collect()
    assert [r[0] for r in blank] == [index.prior] and not math.isnan(index.prior)
    assert set(docs.columns) < set(found.columns)
    assert toxicity.score(empty, index).count() == 0
    for one in (labelled.limit(0), labelled.where("toxic = 0"), labelled.withColumn("toxic", F.lit(1))):
        bare = toxicity.fit(one, one)
        assert len(bare.terms) == 0
        scores = {r["_score"] for r in toxicity.score(docs, bare).collect()}
        assert scores == {1.0 if "toxic" in one.columns and one.where("toxic = 1").count() else 0.0}
