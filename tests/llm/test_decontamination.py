import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import pairs_of, sentence
from wardstat.llm import decontamination


def shingle_set(text, n):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}, len(words)


def plain(docs, items, n=5, share=0.8):
    out = Counter()
    for key, text in docs:
        for item, content in items:
            own, count = shingle_set(content, n)
            k = min(n, count)
            own, _ = shingle_set(content, k) if k else (set(), 0)
            if own:
                have = len(own & shingle_set(text, k)[0]) / len(own)
                if have >= share - 1e-9:
                    out[(key, item, round(have, 9))] += 1
    return out


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(21)
    rows = [(i, sentence(rng, rng.randrange(5, 60))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "seven copper"), (None, "no number here at all"), (3, rows[3][1])]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")


@pytest.fixture(scope="module")
def mixed(docs, items):
    """Documents with whole, damaged and half items inside."""
    rng = random.Random(22)
    known = [(r["item_id"], r["text"]) for r in items.collect() if r["text"]]
    rows = []
    for i in range(80):
        words = rng.choice(known)[1].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        words = words[: len(words) - rng.choice([0, 0, len(words) // 6, len(words) // 2])]
        rows.append((500 + i, sentence(rng, rng.randrange(0, 200)) + "\n" + " , ".join(words).upper() + "! " + sentence(rng, 30)))
    return docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame(rows, "doc_id long, text string"))


def test_finds_exactly_what_brute_force_finds(spark, mixed, items, monkeypatch):
    want = plain(pairs_of(mixed), [(r["item_id"], r["text"]) for r in items.collect()])
    assert len(want) > 40 and any(s < 1 for _, _, s in want)
    for size in (decontamination.PASS_BYTES, 2000):
        monkeypatch.setattr(decontamination, "PASS_BYTES", size)
        got = Counter((r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in decontamination.find_items(spark, mixed, items).collect())
        assert got == want
        kept = decontamination.drop_contaminated(spark, mixed, items)
        bad = {(k, t) for k, t in pairs_of(mixed) if plain([(k, t)], [(r["item_id"], r["text"]) for r in items.collect()])}
        assert Counter(pairs_of(kept)) == Counter(p for p in pairs_of(mixed) if p not in bad)


def test_empty_tables(spark, docs, empty, items):
    assert decontamination.find_items(spark, empty, items).count() == 0
    assert decontamination.find_items(spark, docs, items.limit(0)).count() == 0
    kept = decontamination.drop_contaminated(spark, docs, items.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()
