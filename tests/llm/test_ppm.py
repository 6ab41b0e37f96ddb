import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.helpers import pairs_of
from wardstat.llm import ppm
from wardstat.llm.common import held_out


def plain(rows, trained):
    """Base and PPM-C scores by walking contexts symbol by symbol."""
    words, counts = Counter(), [defaultdict(Counter) for _ in range(5)]
    for (_, text), learn in zip(rows, trained):
        text = (text or "").encode()
        if learn:
            words.update([*text.lower().split(), None])
            data = b"\xfe" * 4 + text + b"\xff"
            for i in range(4, len(data)):
                for order in range(5):
                    counts[order][data[i - order : i]][data[i]] += 1
    total, distinct = sum(words.values()), len(words)
    for _, text in rows:
        text = (text or "").encode()
        tokens = [*text.lower().split(), None]
        base = sum(math.log10((words[t] + 1) / (total + distinct + 1)) for t in tokens)
        score, data = 0.0, b"\xfe" * 4 + text + b"\xff"
        for i in range(4, len(data)):
            gone = set()
            for order in range(4, -1, -1):
                left = {s: n for s, n in counts[order].get(data[i - order : i], {}).items() if s not in gone}
                if left:
                    room = sum(left.values()) + len(left)
                    if data[i] in left:
                        score += math.log10(left[data[i]] / room)
                        break
                    score += math.log10(len(left) / room)
                    gone |= set(left)
            else:
                score -= math.log10(255 - len(gone))
        yield len(tokens), sum(words[t] > 0 for t in tokens), total, base, score


def compare(docs, monkeypatch, blocks):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", blocks)
    docs = docs.where("coalesce(length(text), 0) < 3000")
    rows = pairs_of(docs)
    trained = [zlib.crc32(b"" if k is None else str(k).encode()) % 7 != 2 for k, _ in rows]
    want = sorted(zip([k for k, _ in rows], plain(rows, trained)), key=lambda x: (x[0] is None, x[0], x[1]))
    found = ppm.score(docs, held_out("doc_id", 7, 2)).collect()
    got = sorted(((r["doc_id"], tuple(r[2:])) for r in found), key=lambda x: (x[0] is None, x[0], x[1]))
    assert len(got) == len(want)
    for (a, x), (b, y) in zip(got, want):
        assert a == b and x[:3] == y[:3], (a, x, y)
        assert math.isclose(x[3], y[3], abs_tol=1e-6) and math.isclose(x[4], y[4], rel_tol=1e-5, abs_tol=1e-4), (a, x, y)


def test_scores_equal_plain_python(docs, monkeypatch):
    compare(docs, monkeypatch, 8_000)


def test_one_block_and_nothing_to_learn_from(docs, monkeypatch):
    compare(docs.limit(20), monkeypatch, 1 << 25)
    alone = ppm.score(docs.where("doc_id = 3"), F.lit(True)).first()
    assert (alone["n_tokens"], alone["n_known"], alone["train_tokens"]) == (2, 0, 0)
    assert math.isclose(alone["score"], -2 * math.log10(255), rel_tol=1e-6)


def test_long_text_and_empty_table(docs, empty):
    assert ppm.score(docs, held_out("doc_id", 7, 2)).count() == docs.count()
    assert ppm.score(empty, held_out("doc_id", 7, 2)).count() == 0
