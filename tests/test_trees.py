"""Trees against plain loops over all rows and all splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.operators import trees as grown

INPUTS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    rows = []
    for i in range(1200):
        x = [float(rng.integers(0, 9)), float(rng.integers(0, 2)), round(float(rng.normal()), 1), float(rng.integers(0, 40))]
        y = float(rng.random() < 1 / (1 + np.exp(-(x[0] - 4) * (1 if x[1] else -1) - x[2])))
        rows.append((i, *x, y, 3.0 if y else 1.0))
    path = str(tmp_path_factory.mktemp("frame") / "t")
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double, w double")
    df.withColumn("_key", F.xxhash64("id")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def cuts(frame):
    return grown.bin_cuts(frame, INPUTS, {}, 256)


@pytest.fixture(scope="module")
def rows(frame):
    return frame.toPandas()


def split_of(x, columns, score, least):
    """The best (gain, input, threshold) by trying every value of every input."""
    best = (0.0, None, None)
    for f in columns:
        for v in np.unique(x[:, f])[1:]:
            left = x[:, f] < v
            if least(left):
                gain = score(left) + score(~left) - score(left | ~left)
                if gain > best[0] + 1e-9 * abs(best[0]):
                    best = (gain, f, v)
    return best


def plain_boost(rows, s):
    x, y, w = rows[INPUTS].to_numpy(), rows["label"].to_numpy(), rows["w"].to_numpy()
    key = rows["_key"].to_numpy().view(np.uint64)
    margin = np.zeros(len(x))
    for t in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        columns = grown.chosen_inputs(s.seed, 2 * t, len(INPUTS), max(1, int(s.columns * len(INPUTS))))
        drawn = grown.draws(key, s.seed, 2 * t + 1) < s.rows if s.rows < 1 else np.ones(len(x), bool)

        def grow(own, here, depth):
            """``own``: drawn rows that choose; ``here``: all rows that get the value."""
            square = lambda m: g[own][m].sum() ** 2 / (h[own][m].sum() + s.penalty)
            least = lambda m: min(h[own][m].sum(), h[own][~m].sum()) >= s.least_child
            gain, f, v = split_of(x[own], columns, square, least) if depth < s.depth else (0.0, None, None)
            if f is None or gain <= grown.LEAST_GAIN:
                margin[here] -= s.step * g[own].sum() / (h[own].sum() + s.penalty)
                return
            grow(own[x[own, f] < v], here[x[here, f] < v], depth + 1)
            grow(own[x[own, f] >= v], here[x[here, f] >= v], depth + 1)

        grow(np.flatnonzero(drawn), np.arange(len(x)), 0)
    return 1 / (1 + np.exp(-margin))


def plain_forest(rows, s, weights):
    x, y = rows[INPUTS].to_numpy(), rows["label"].to_numpy().astype(int)
    key = rows["_key"].to_numpy().view(np.uint64)
    out = np.zeros(len(x))
    for t in range(s.trees):
        times = np.searchsorted(grown.POISSON, grown.draws(key, s.seed, t), side="right") if s.bootstrap else np.ones(len(x), int)

        def grow(own, here, depth, place):
            w = times[own] * weights[y[own]]

            def purity(m):
                c = np.bincount(y[own][m], w[m], 2)
                return (c * c).sum() / max(c.sum(), 1e-300)

            number = t * 2 ** (s.depth + 1) + place + 1
            columns = grown.chosen_inputs(s.seed, number, len(INPUTS), s.inputs)
            least = lambda m: min(m.sum(), (~m).sum()) >= s.least_leaf
            gain, f, v = split_of(x[own], columns, purity, least) if depth < s.depth else (0.0, None, None)
            if f is None or gain <= 1e-9 * w.sum():
                out[here] += (w * y[own]).sum() / w.sum()
                return
            grow(own[x[own, f] < v], here[x[here, f] < v], depth + 1, 2 * place + 1)
            grow(own[x[own, f] >= v], here[x[here, f] >= v], depth + 1, 2 * place + 2)

        grow(np.flatnonzero(times > 0), np.arange(len(x)), 0, 0)
    return out / s.trees


def test_boosted_trees_equal_plain_loops(frame, cuts, rows):
    s = grown.BoostSettings(rounds=6, depth=3, step=0.3, columns=0.75)
    trees = grown.boost(frame, INPUTS, "w", cuts, s)
    got = grown.probabilities(trees, rows[INPUTS].to_numpy(), boosted=True)
    assert np.abs(got - plain_boost(rows, s)).max() < 1e-7
    assert (trees.gain[trees.feature >= 0] > 0).all() and (trees.feature >= 0).sum() > 20


def test_forest_equals_plain_loops(frame, cuts, rows):
    s = grown.ForestSettings(trees=5, depth=4, least_leaf=15, inputs=2)
    weights = np.array([1.0, 3.0])
    trees = grown.forest(frame, INPUTS, "w", cuts, s)
    got = grown.probabilities(trees, rows[INPUTS].to_numpy(), boosted=False)
    assert np.abs(got - plain_forest(rows, s, weights)).max() < 1e-12
    assert (trees.n_rows[trees.feature == -1] >= 15).all()


def test_models_do_not_depend_on_partitions(frame, cuts, monkeypatch):
    """In one task, and on seven partitions whose sums are added up."""
    boosted = grown.BoostSettings(rounds=4, depth=3)
    drawn = grown.ForestSettings(trees=4, depth=3)
    other = frame.repartition(7, "d").sortWithinPartitions(F.desc("id"))
    for grow, s in ((grown.boost, boosted), (grown.forest, drawn)):
        a = grow(frame, INPUTS, "w", cuts, s)
        with monkeypatch.context() as m:
            m.setattr(grown, "BOOSTED_ROWS", 150)
            m.setattr(grown, "FOREST_ROWS", 150)
            b = grow(other, INPUTS, "w", cuts, s)
        assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_blocks_add_up_on_executors_too(frame, cuts, monkeypatch):
    s = grown.BoostSettings(rounds=2, depth=2)
    want = grown.boost(frame, INPUTS, "w", cuts, s)
    monkeypatch.setattr(grown, "SUMMED_BYTES", 1)
    monkeypatch.setattr(grown, "BOOSTED_ROWS", 200)
    got = grown.boost(frame.repartition(6), INPUTS, "w", cuts, s)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))


def test_nodes_of_a_forest_in_many_passes(frame, cuts, monkeypatch):
    s = grown.ForestSettings(trees=4, depth=4)
    want = grown.forest(frame, INPUTS, "w", cuts, s)
    monkeypatch.setattr(grown, "SUM_BYTES", 24 * 3 * grown.Layout(cuts).size)
    got = grown.forest(frame, INPUTS, "w", cuts, s)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))


def test_lineage_is_cut_and_the_model_stays(frame, cuts, monkeypatch):
    s = grown.BoostSettings(rounds=5, depth=2)
    want = grown.boost(frame, INPUTS, "w", cuts, s)
    monkeypatch.setattr(grown, "CHECKPOINT_ROUNDS", 2)
    monkeypatch.setattr(grown, "BOOSTED_ROWS", 400)
    got = grown.boost(frame.repartition(3), INPUTS, "w", cuts, s)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))


def test_draws_are_even_and_poisson():
    key = np.arange(200_000, dtype=np.uint64)
    u = grown.draws(key, 42, 3)
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.005
    assert abs(np.corrcoef(u, grown.draws(key, 42, 4))[0, 1]) < 0.01
    times = np.searchsorted(grown.POISSON, u, side="right")
    assert times.mean() == pytest.approx(1, abs=0.01) and times.var() == pytest.approx(1, abs=0.02)
    assert len(set(map(tuple, (grown.chosen_inputs(1, n, 9, 4) for n in range(50))))) > 20


def test_ledger_holds_the_model(spark, frame, cuts, rows):
    trees = grown.boost(frame, INPUTS, "w", cuts, grown.BoostSettings(rounds=3, depth=4))
    table = grown.ledger(spark, trees, INPUTS)
    x = rows[INPUTS].to_numpy()
    again = grown.from_ledger(table, INPUTS)
    assert np.array_equal(grown.probabilities(trees, x, True), grown.probabilities(again, x, True))
    # A node's rows and weight are those of its children.
    found = {(r["tree"], r["node"]): r for r in table.collect()}
    for (t, node), r in found.items():
        if r["feature"] is not None:
            both = [found[t, 2 * node + 1], found[t, 2 * node + 2]]
            assert sum(c["n_rows"] for c in both) == r["n_rows"]
            assert sum(c["weight"] for c in both) == pytest.approx(r["weight"])


def test_scores_of_a_table_are_those_of_the_arrays(spark, frame, cuts, rows):
    trees = grown.forest(frame, INPUTS, "w", cuts, grown.ForestSettings(trees=7, depth=5))
    got = grown.with_tree_probability(frame.select("id", *INPUTS), trees, INPUTS, "p", False).orderBy("id").toPandas()
    x = rows.sort_values("id")[INPUTS].to_numpy()
    assert np.array_equal(got["p"].to_numpy(), grown.probabilities(trees, x, False))
    with pytest.raises(Exception, match="b is null"):
        grown.with_tree_probability(frame.select("id", "a", F.lit(None).cast("double").alias("b"), "c", "d"), trees, INPUTS, "p", False).collect()


def test_coarse_inputs_are_cut_at_quantiles(spark, frame):
    cuts = grown.bin_cuts(frame, INPUTS, {"d": 40}, 8)
    assert len(cuts[3]) <= 7 and len(cuts[0]) == 8
    assert grown.boost(frame, INPUTS, "w", cuts, grown.BoostSettings(rounds=2, depth=2)).feature[0, 0] >= 0


def test_a_single_class_and_a_constant_input_grow_no_tree(spark):
    df = spark.range(60).selectExpr("1.0D a", "2.0D b", "3.0D c", "4.0D d", "0.0D label", "1.0D w", "xxhash64(id) _key")
    cuts = grown.bin_cuts(df, INPUTS, {}, 256)
    assert [len(c) for c in cuts] == [0, 0, 0, 0]
    one = grown.boost(df, INPUTS, "w", cuts, grown.BoostSettings(rounds=2, depth=2))
    other = grown.forest(df, INPUTS, "w", cuts, grown.ForestSettings(trees=2, depth=2))
    assert (one.feature[:, 0] == -1).all() and (other.feature[:, 0] == -1).all()
    assert (one.value[:, 0] < 0).all() and (other.value[:, 0] == 0).all()


def test_passes_sum_the_smaller_child_and_no_more_tasks_than_run_at_once(frame, cuts, monkeypatch):
    s = grown.BoostSettings(rounds=3, depth=4)
    want = grown.boost(frame, INPUTS, "w", cuts, s)
    shapes, tasks = [], set()
    plain = grown._Spread.summed

    def summed(self, sums, shape):
        shapes.append(shape)
        tasks.add(self.rows.getNumPartitions())
        return plain(self, sums, shape)

    monkeypatch.setattr(grown._Spread, "summed", summed)
    monkeypatch.setattr(grown, "BOOSTED_ROWS", 50)
    got = grown.boost(frame.repartition(16), INPUTS, "w", cuts, s)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))
    above_last = (got.feature[:, : 2 ** (s.depth - 1) - 1] >= 0).sum()
    assert sum(shape[0] for shape in shapes) == s.rounds + above_last
    assert 1 < max(tasks) <= frame.sparkSession.sparkContext.defaultParallelism


def test_sums_of_a_forest_do_not_reach_the_driver(frame, cuts, monkeypatch):
    s = grown.ForestSettings(trees=4, depth=4)
    want = grown.forest(frame, INPUTS, "w", cuts, s)
    sent = []
    plain = grown._Spread.chosen

    def chosen(self, sums, shape, choose):
        found = plain(self, sums, shape, choose)
        sent.append(sum(x.nbytes for row in found for x in row) / shape[0])
        return found

    monkeypatch.setattr(grown._Spread, "chosen", chosen, raising=False)
    monkeypatch.setattr(grown._Spread, "summed", None)
    monkeypatch.setattr(grown, "FOREST_ROWS", 200)
    got = grown.forest(frame.repartition(6), INPUTS, "w", cuts, s)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))
    # About a hundred bytes of each node, however many bins and partitions there are.
    assert len(sent) == s.depth and max(sent) < 150 < 24 * grown.Layout(cuts).size


def test_poisson_draws_and_bundled_codes_are_the_plain_ones():
    edges = np.concatenate([grown.POISSON, np.nextafter(grown.POISSON, 0), np.arange(4096) / 4096, [1 - 2.0**-53]])
    u = np.concatenate([edges[edges < 1], grown.draws(np.arange(50_000, dtype=np.uint64), 1, 1)])
    assert np.array_equal(grown.poisson(u), np.searchsorted(grown.POISSON, u, side="right"))
    rng = np.random.default_rng(5)
    sizes = [2, 300, 3, 1, 40, 2, 25, 7]
    layout = grown.Layout([np.arange(1.0, n) for n in sizes])
    packs = grown.bundles(layout)
    assert sorted(f for b in packs for f in b.inputs) == list(range(len(sizes))) and len(packs) < len(sizes)
    bins = np.stack([rng.integers(0, n, 500) for n in sizes], axis=1).astype(np.uint16)
    zero = np.zeros(500)
    codes = grown._with_codes(packs)(grown.Block(np.asfortranarray(bins), zero, zero, zero, zero)).codes
    for bundle, code in zip(packs, codes.T):
        sums = np.bincount(code, minlength=len(bundle.marks)) @ bundle.marks
        plain = np.concatenate([np.bincount(bins[:, f], minlength=sizes[f]) for f in bundle.inputs])
        assert np.array_equal(sums, plain)
    feature, cut = np.array([4, 1, 7, -1, -1, -1, -1]), np.array([17, 290, 2, 0, 0, 0, 0])
    left = bins[:, 4] <= 17
    want = np.where(left, 3 + (bins[:, 1] > 290), 5 + (bins[:, 7] > 2))
    assert np.array_equal(grown._walked(codes, packs, feature, cut, 2), want)


def test_ways_down_deep_trees_are_those_of_the_bins():
    """Trees of seven levels with leaves at all of them, from codes: more splits than one number has bits."""
    rng = np.random.default_rng(8)
    sizes = [2, 300, 3, 40, 2, 25, 7]
    packs = grown.bundles(grown.Layout([np.arange(1.0, n) for n in sizes]))
    bins = np.stack([rng.integers(0, n, 3000) for n in sizes], axis=1).astype(np.uint16)
    zero = np.zeros(3000)
    codes = grown._with_codes(packs)(grown.Block(np.asfortranarray(bins), zero, zero, zero, zero)).codes
    for levels, leaves in ((0, 0.0), (3, 0.2), (5, 0.1), (7, 0.0), (7, 0.1)):
        feature = np.where(rng.random(2**8 - 1) < leaves, -1, rng.integers(0, len(sizes), 2**8 - 1))
        cut = (rng.random(len(feature)) * np.take(sizes, feature)).astype(int)
        want = np.zeros(len(bins), int)
        for _ in range(levels):
            here = feature[want]
            right = bins[np.arange(len(bins)), here] > cut[want]
            want = np.where(here >= 0, 2 * want + 1 + right, want)
        assert np.array_equal(grown._walked(codes, packs, feature, cut, levels), want)


def test_a_round_reads_blocks_that_are_held_for_some_rounds(frame, cuts, monkeypatch):
    """Margins are held anew every few rounds and not in each; the blocks lie uncompressed, and fill up."""
    s = grown.BoostSettings(rounds=7, depth=3)
    want = grown.boost(frame, INPUTS, "w", cuts, s)
    changes = []
    plain = grown._Spread.changed

    def changed(self, change, cut_lineage):
        plain(self, change, cut_lineage)
        changes.append(self.rows.getStorageLevel().deserialized)

    monkeypatch.setattr(grown._Spread, "changed", changed)
    monkeypatch.setattr(grown, "BOOSTED_ROWS", 300)
    monkeypatch.setattr(grown, "PASS_ROWS", 70)
    monkeypatch.setattr(grown, "HELD_ROUNDS", 3)
    got = grown.boost(frame.repartition(5), INPUTS, "w", cuts, s)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))
    assert changes == [True] * 3
    block = lambda n: grown.Block(np.zeros((n, 2), np.uint8), *(np.arange(n) * 1.0 for _ in range(4)))
    assert [len(b.label) for b in grown._merged(map(block, (5, 0, 90, 70, 1)), 70)] == [70, 70, 26]


def test_exponential_is_near_numpys():
    x = np.concatenate([np.linspace(-750, 750, 30_001), np.random.default_rng(3).normal(0, 2, 30_000), [0.0, -0.0, 1e-300]])
    near = np.exp(np.clip(x, -700, 700))
    assert (np.abs(grown.exp(x) - near) <= 4e-16 * near).all()


def test_passes_of_the_jvm_give_the_numbers_of_numpy(spark, cuts, frame, monkeypatch):
    """Inputs of few and of many values, weights and labels that are not whole, and no Python worker in a pass."""
    frame = frame.withColumn("w", F.col("w") + F.col("a") / 7).withColumn("d", F.col("id").cast("double")).repartition(5)
    wide = grown.bin_cuts(frame, INPUTS, {}, 2000)
    assert len(wide[3]) > 256
    odd = frame.withColumn("label", F.col("label") * 0.75 + 0.125)
    boosted = [grown.BoostSettings(rounds=7, depth=4), grown.BoostSettings(rounds=3, depth=2, rows=1.0, columns=1.0, step=1.0)]
    drawn = [grown.ForestSettings(trees=5, depth=5, least_leaf=1), grown.ForestSettings(trees=2, depth=3, inputs=4, bootstrap=False)]
    runs = [(grown.boost, s, rows) for s in boosted for rows in (frame, odd)] + [(grown.forest, s, frame) for s in drawn]
    for own in (wide, [c[:3] for c in wide]):
        for grow, s, rows in runs:
            here = grow(rows, INPUTS, "w", own, s)
            with monkeypatch.context() as m:
                m.setattr(grown, "BOOSTED_ROWS", 250)
                m.setattr(grown, "FOREST_ROWS", 250)
                m.setattr(grown, "_unpacked", None)
                m.setattr(grown, "_Here", None)
                there = grow(rows, INPUTS, "w", own, s)
            assert all(np.array_equal(x, y) for x, y in zip(here, there))
            assert (here.feature >= 0).any()


def test_blocks_are_held_in_the_jvm(spark, frame, cuts, monkeypatch):
    """A pass starts no Python worker: blocks lie on the executors as objects of the JVM, and so do the drawn rows."""
    kinds = set()
    plain = grown._Spread.summed

    def summed(self, sums, shape):
        found = plain(self, sums, shape)
        kinds.update(rdd._jrdd.first().getClass().getName() for rdd in (self.rows, self.read))
        return found

    monkeypatch.setattr(grown._Spread, "summed", summed)
    monkeypatch.setattr(grown, "BOOSTED_ROWS", 300)
    grown.boost(frame.repartition(3), INPUTS, "w", cuts, grown.BoostSettings(rounds=2, depth=2))
    assert kinds == {"wardstat.trees.Passes$Block", "wardstat.trees.Passes$Drawn"}


def test_scores_are_those_of_the_splits():
    """Leaves at all levels, values at thresholds, beyond them and no numbers; more thresholds than a byte counts."""
    rng = np.random.default_rng(9)
    for depth, values in ((0, 5), (1, 5), (4, 5), (6, 2000)):
        trees = grown.no_trees(9, depth)
        for t in range(9):
            trees.feature[t, 0] = -1
            for node in range(2**depth - 1):
                if trees.feature[t, node] == -1 and rng.random() < 0.8:
                    trees.feature[t, node], trees.threshold[t, node] = rng.integers(0, 3), rng.integers(0, values) / 4
                    trees.feature[t, 2 * node + 1 : 2 * node + 3] = -1
            trees.value[t] = rng.normal(size=trees.value.shape[1])
        x = rng.integers(-1, values + 1, (9000, 3)) / 4
        x[::50, 0], x[7::50, 1] = np.nan, np.inf
        want = np.zeros(len(x))
        for i in range(0, len(x), 3):
            for t in range(9):
                node = 0
                while trees.feature[t, node] >= 0:
                    node = 2 * node + (2 if x[i, trees.feature[t, node]] >= trees.threshold[t, node] else 1)
                want[i] += trees.value[t, node]
        assert np.array_equal(grown.probabilities(trees, x, False)[::3], want[::3] / 9)
        assert np.allclose(grown.probabilities(trees, x, True)[::3], 1 / (1 + np.exp(-want[::3])), atol=0, rtol=1e-12)
