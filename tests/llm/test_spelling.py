import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, pairs_of
from wardstat.llm import spelling
from wardstat.llm.common import table
from wardstat.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    return counts


def plain(rows):
    """The contract's rows; near words by the shared results of deleting one character."""
    n = {w: c for w, c in counted(rows).items() if c >= 5}
    holes = defaultdict(set)
    for w in n:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for hole, own in holes.items():
        for a in own:
            for b in own:
                if a != b and ("\0" in hole or hole in (a, b)):
                    near[a].add(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select(COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark):
    want = plain(pairs_of(table(spark, SF, "documents")))
    assert rows_of(QUERIES["op12_spelling_variants"](spark, SF)) == want
    assert sum(r[4] for r in want) > 100 and any(r[1] for r in want)


@pytest.fixture(scope="module")
def noisy(spark):
    """Words of 6 to 40 characters with accents, chains of forms, ties and repeated letters."""
    rng = random.Random(11)
    stems = ["".join(rng.choice("abcdeéñÿ") for _ in range(rng.choice([6, 6, 7, 8, 9, 11, 15, 31, 32, 33, 40]))) for _ in range(60)]
    stems += ["aaaaaa", "aaaaaaa", "abababab", "ababababa", "x" * 70]
    words = Counter()
    for stem in stems:
        words[stem] += rng.choice([5, 30, 200])
        for _ in range(12):
            at, own = rng.randrange(len(stem) + 1), rng.choice("abcdeéñÿ")
            other = rng.choice([stem[:at] + own + stem[at:], stem[:at] + own + stem[at + 1 :], stem[:at] + stem[at + 1 :]])
            words[other] += rng.choice([4, 5, 6, 25, 30, 150])
    tokens = [w for w, c in words.items() for _ in range(c)]
    rng.shuffle(tokens)
    cut = [tokens[i : i + 50] for i in range(0, len(tokens), 50)]
    rows = [(i, rng.choice([" ", "-", "_", "9", "日"]).join(part)) for i, part in enumerate(cut)]
    rows += [(None, "aaaaaa Aaaaaa ÀÀÀÀÀÀÀ"), (0, None), (1, ""), (2, "\u00d7\u00f7" * 4)] * 3
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)


def test_noisy_words(noisy):
    want = plain(pairs_of(noisy))
    assert rows_of(spelling.variants(noisy)) == want
    assert any(r[2] != r[1] for r in want if r[1]) and max(len(r[0]) for r in want) >= 40


def test_long_lists_meet_in_cells(noisy, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 7)
    assert rows_of(spelling.variants(noisy)) == plain(pairs_of(noisy))


def test_few_grams_are_extended(noisy, monkeypatch):
    monkeypatch.setattr(spelling, "EXTENDED", 150)
    assert rows_of(spelling.variants(noisy)) == plain(pairs_of(noisy))


def test_odd_rows_and_empty_tables(docs, empty):
    assert rows_of(spelling.variants(docs)) == plain(pairs_of(docs))
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(docs.where(F.col("text").isNull())).columns == COLUMNS


def test_an_edit_affects_no_more_grams_than_the_bound():
    rng = random.Random(2)
    frequent = {"".join(rng.choice("ab") for _ in range(n)): 1 for n in (2, 3, 4) for _ in range(6)}
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(6, 13)))
        at, own = rng.randrange(len(a)), rng.choice("abc")
        b = rng.choice([a[:at] + own + a[at:], a[:at] + own + a[at + 1 :], a[:at] + a[at + 1 :]])
        if len(b) >= 6 and a != b:
            assert spelling.one_edit(a, b)
            assert {k for k, _ in spelling.list_keys(a, frequent)} & {k for k, _ in spelling.list_keys(b, frequent)}, (a, b)


def test_checksums_and_counts():
    texts = ["Straße ÉCOLE école abcdefg", "", "abcdef-abcdef", "abcdef"]
    got = spelling.count_words(["1", "2", "3", ""], pa.array(texts), damaged=10**9)
    assert got == {"straße": 1, "abcdefg": 1, "abcdef": 3}
    data = np.frombuffer(b"hello world", np.uint8)
    heads = np.array([zlib.crc32(b"7:"), 0], np.uint32)
    found = spelling.checksums(data, np.array([0, 6]), np.array([5, 5]), heads)
    assert found.tolist() == [zlib.crc32(b"7:hello"), zlib.crc32(b"world")]


def test_no_side_with_rows_per_word_or_list_is_broadcast(spark, noisy):
    """Files of words are small beside what their lists take in memory, so their size tells Spark nothing."""
    words = spelling.stored(spelling.vocabulary(noisy, "doc_id", "text", 1), "test-words")
    forms = spelling.stored(words.selectExpr("word", "substring(word, 2) as form"), "test-forms")
    for df in (spelling.near_words(words), spelling.roots(forms), spelling.variants(noisy, least_count=1)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
