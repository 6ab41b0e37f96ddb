import random
import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import pairs_of
from wardstat.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def inside(n):
        seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}

    lines, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own:
            dup += line in lines
            dup_chars += (line in lines) * sum(map(len, own))
            lines.add(line)
    chars = sum(map(len, words))
    covered = {n: sum(len(words[j]) for j in inside(n)) for n in quality.NGRAM_LIMITS}
    repeat = len(inside(3))
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    within = lambda own, share: own <= share * chars + quality.ALLOWED
    kept = not failed and within(dup_chars, quality.LINE_LIMIT) and all(within(covered[n], x) for n, x in quality.NGRAM_LIMITS.items())
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), dup, repeat, failed, kept)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab é#\n\r\t", max_size=80), max_size=5))
def test_counts_equal_plain_python(texts):
    m = quality.measure(pa.array(texts, pa.string()))
    assert list(zip(*(m[c].tolist() for c in quality.COUNTS))) == [plain(t)[:5] for t in texts]


def test_verdicts_on_all_kinds_of_rows(docs, empty):
    repeated = docs.sparkSession.createDataFrame([(900, "\n".join(["alpha beta gamma delta epsilon zeta eta theta"] * 9)), (901, " ".join(map(str, range(80))))], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(repeated)
    got = Counter((r["doc_id"], *(r[c] for c in quality.COUNTS), r["base_failed"], r["kept"]) for r in quality.quality_rules(both).collect())
    assert got == Counter((k, *plain(t)) for k, t in pairs_of(both))
    assert quality.quality_rules(docs).count() == docs.count() and quality.quality_rules(empty).count() == 0


def test_the_coverages_decide(spark):
    """Texts that pass the base rule: with much in repeated runs they go, with a heading at both ends they stay."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    run = " ".join(word() for _ in range(12))
    heading = " ".join(word() for _ in range(8))
    body = lambda n: " ".join(word() for _ in range(n))
    texts = {
        1: " ".join(f"{run} {body(15)}" for _ in range(40)),  # 44 % of the characters in repeated ten-word runs
        2: f"{heading}\n{body(60)}\n{heading}",
        3: body(3000),
        4: "\n".join([*(body(10) for _ in range(300)), *[body(9)] * 40]),  # a line that comes forty times
        5: f"{heading}\n{body(20_000)}\n{heading}",
        6: f"{run}\n{body(4000)}\n" * 2,  # all of it comes again
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.quality_rules(df).collect()}
    assert got == {1: (False, False), 2: (False, True), 3: (False, True), 4: (False, False), 5: (False, True), 6: (True, False)}
