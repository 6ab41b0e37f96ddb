import random

from wardstat.llm import components
from wardstat.llm.common import stored
from wardstat.llm.components import connected_components, with_links


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(4000, 4200)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert {r["node"]: r["component"] for r in found} == {x: root(x) for x in parent}
    assert len(found) == len(parent)
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def _found(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return dict(rows)


def test_more_links_join_what_is_known(spark):
    """Components and further links give what all links together give: parts joined over single nodes, links within a part,
    self-links, repeated ones and no link at all."""
    rng = random.Random(2)
    old = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    new = [(rng.randrange(260), rng.randrange(260)) for _ in range(60)] * 2 + [old[0], (5, 5), (999, 998)]
    kind = "a long, b long"
    known = stored(connected_components(spark.createDataFrame(old, kind), "a", "b"), "known")
    for links in (new, []):
        found = _found(with_links(known, spark.createDataFrame(links, kind)))
        assert found == _found(connected_components(spark.createDataFrame(old + links, kind), "a", "b"))


def test_a_round_is_four_short_queries(spark, monkeypatch):
    """What each round writes: a node's least, large and small stars; no query of its own tells whether it was the last."""
    written = []
    monkeypatch.setattr(components, "stored", lambda df, name: written.append(df) or stored(df, name))
    chain = [(i, i + 1) for i in range(40)]
    assert set(_found(connected_components(spark.createDataFrame(chain, "a long, b long"), "a", "b")).values()) == {0}
    rounds, rest = divmod(len(written) - 2, 4)
    assert rest == 0 and rounds > 1
    shuffles = [df._jdf.queryExecution().optimizedPlan().toString() for df in written[2:]]
    assert sum(x.count("Aggregate") + x.count("Join") for x in shuffles) == 4 * rounds
