import math
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import pairs_of
from wardstat.llm import sharding


def place(spark, tree, n=4000):
    return [r[0] for r in spark.range(n).select("id", sharding.shard_of(F.col("id"), tree).alias("s")).orderBy("id").select("s").collect()]


def descend(key, tree):
    """The shard of a key by plain loops: at each level the child of least -ln(u) / weight."""
    own = [(s, i) for i, s in enumerate(tree) if s.weight > 0]
    seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)

    def draw(name, weight):
        return -math.log(((xxhash.xxh64_intdigest(name.encode(), seed) >> 11) + 0.5) * 2.0**-53) / weight, name

    for name_of in (lambda s, i: s.region, lambda s, i: f"{s.region}/{s.rack}", lambda s, i: f"{s.region}/{s.rack}/{i}"):
        weights = Counter()
        for s, i in own:
            weights[name_of(s, i)] += s.weight
        best = min(draw(name, weight) for name, weight in weights.items())[1]
        own = [(s, i) for s, i in own if name_of(s, i) == best]
    return own[0][1]


def test_descent_equals_plain_loops(spark):
    even = sharding.topology(40)
    uneven = [s._replace(weight=(0.0, 0.5, 1.0, 3.0)[i % 4]) for i, s in enumerate(even)]
    for tree in (even, sharding.grown(even), uneven):
        assert place(spark, tree, 1500) == [descend(k, tree) for k in range(1500)]


def test_sizes_checksums_and_gapless_slots(docs, empty):
    tree = sharding.topology(40)
    found = sharding.assign(docs, tree, sharding.grown(tree)).collect()
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found)
    assert sizes == Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in pairs_of(docs))
    slots = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = defaultdict(set)
    for r in found:
        by_key[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(len(s) == 1 for s in by_key.values())
    assert sharding.assign(empty, tree, sharding.grown(tree)).count() == 0


def test_shards_are_even_and_a_further_one_takes_its_share(spark):
    tree = sharding.topology(40)
    before, after = place(spark, tree), place(spark, sharding.grown(tree))
    share = Counter(before)
    assert len(share) == 40 and max(share.values()) < 2 * 4000 / 40
    moved = [(a, b) for a, b in zip(before, after) if a != b]
    assert all(b == 40 for _, b in moved) and 0.5 < len(moved) / (4000 / 41) < 1.5


def test_a_weight_moves_keys_only_into_or_out_of_its_subtree(spark):
    tree = sharding.topology(40)
    lighter = [s._replace(weight=0.25) if i == 7 else s for i, s in enumerate(tree)]
    region = tree[7].region
    moved = [(a, b) for a, b in zip(place(spark, tree), place(spark, lighter)) if a != b]
    assert moved and all(region in (tree[a].region, tree[b].region) for a, b in moved)
    # Within the region, racks other than the shard's own only receive.
    assert all(tree[a].rack == tree[7].rack for a, b in moved if tree[a].region == tree[b].region == region)


def test_weights_count_and_empty_shards_take_nothing(spark):
    tree = [s._replace(weight=0.0 if i == 3 else 3.0 if i == 5 else 1.0) for i, s in enumerate(sharding.topology(8, 2, 2))]
    share = Counter(place(spark, tree))
    assert 3 not in share and 2.2 < share[5] / (sum(share[i] for i in (0, 1, 2, 4, 6, 7)) / 6) < 3.9


def test_written_shards(docs, tmp_path):
    tree = sharding.topology(4, 2, 1)
    sharding.write_shards(docs, str(tmp_path / "s"), tree)
    back = docs.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and set(r[0] for r in back.select("_shard").distinct().collect()) <= set(range(4))


def test_native_plan(docs):
    tree = sharding.topology(40)
    plan = sharding.assign(docs, tree, sharding.grown(tree))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
