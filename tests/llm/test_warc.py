import gzip
import hashlib
from collections import Counter, defaultdict

import pytest

from wardstat.llm import warc
from wardstat.llm.common import stored
from wardstat.session import scratch_path


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "word " * 200 + "</p>"
    rows = [(i, f"http://h/{i}", f"<p>{i % 7} {'text ' * (i % 7 * 10)}</p>") for i in range(60)]
    rows += [(100, None, None), (101, "u\r\nInjected: x%0A", ""), (102, "u", long), (103, "u", long), (103, "u", long), (None, "n", long), (102, "v", long), (104, "é", "é\r\n\r\n" * 40_000)]
    rows = [(*r, "clash", 1, "f") for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, bytes int, first string").repartition(4)


def written(spark, pages):
    folder = scratch_path(spark, "warc-test")
    return folder, stored(warc.write_archives(warc.with_kind(pages, "page_id", "url", "html"), folder), "warc-index")


def test_round_trip(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 3000)
    folder, index = written(spark, pages)
    rows = [(r["page_id"], r["url"], (r["html"] or "")) for r in pages.collect()]
    least = defaultdict(list)
    for key, _, html in rows:
        if len(html.encode()) >= 100:
            least[html].append(key)
    want = Counter()
    for key, url, html in rows:
        first = min((k for k in least[html] if k is not None), default=None)
        later = len(least[html]) > 1 and first is not None and (key is None or key > first)
        sha = hashlib.sha256(html.encode()).hexdigest()
        want[(None if key is None else str(key), url, len(html.encode()), sha, "revisit" if later else "response", str(first) if later else None, None if later else html)] += 1
    found = warc.read_records(index, folder)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert index.select("file").distinct().count() > 4


def test_archives_are_plain_warc_and_the_index_finds_single_records(spark, pages):
    folder, index = written(spark, pages)
    for file, in index.select("file").distinct().collect():
        data = gzip.open(file).read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    some = index.where("key in (5, 104)")
    assert sorted(r["name"] for r in warc.read_records(some, folder).collect()) == ["104", "5"]
    for r in some.collect():
        with open(r["file"], "rb") as f:
            f.seek(r["offset"])
            fields, _ = warc.parse(f.read(r["length"]))
        assert fields["X-Key"] == str(r["key"]) and fields["WARC-Payload-Digest"] == "sha256:" + r["digest"]


def test_ranges_join_close_records():
    spans = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP_BYTES, 1), ("a", 17 + 2 * warc.GAP_BYTES, 1), ("b", 0, warc.RANGE_BYTES), ("b", warc.RANGE_BYTES, 1)]
    assert [(f, b, len(g)) for f, b, e, g in warc.ranges(spans)] == [("a", 0, 3), ("a", 17 + 2 * warc.GAP_BYTES, 1), ("b", 0, 1), ("b", warc.RANGE_BYTES, 1)]


def test_damage_and_empty_table(spark, pages):
    folder, index = written(spark, spark.createDataFrame([], pages.schema))
    assert index.count() == 0 and warc.read_records(index, folder).count() == 0
