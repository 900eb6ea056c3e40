"""Golden values on the toy corpus and the cycle graph."""

import pytest

from citeweave.operators import degrees, edges as E
from citeweave.operators.neighbors import neighbors, ranked_neighbors
from citeweave.operators.pagerank import pagerank
from citeweave.plans.graph import build_journal_graph, build_publication_graph

PR = {"1": 1.261561797644, "2": 1.023386092762, "3": 1.893076888697,
      "4": 0.847343180458, "5": 0.487316020219, "6": 0.487316020219}


@pytest.fixture(scope="module")
def pub(toy):
    return build_publication_graph(toy)


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_publication_edges(pub):
    got = sorted((r.src, r.dst) for r in pub.edges.collect())
    assert got == sorted([("1", "2"), ("1", "3"), ("2", "3"), ("2", "3"), ("4", "4"), ("4", "1"), ("6", "1")])


def test_degrees(pub):
    v = {r.id: (r.in_deg, r.out_deg) for r in pub.vertices.collect()}
    assert v == {"1": (2, 2), "2": (1, 2), "3": (3, 0), "4": (1, 2), "5": (0, 0), "6": (0, 1)}
    assert degrees.in_degrees(pub.edges).count() == 4
    assert degrees.out_degrees(pub.edges).count() == 4


def test_pagerank_goldens(pub):
    pr = as_dict(pub.vertices, "id", "pr")
    for k, want in PR.items():
        assert pr[k] == pytest.approx(want, abs=1e-9)
    assert sum(pr.values()) == pytest.approx(6.0, abs=1e-9)


def test_unresolved_and_names(toy, pub):
    assert [(r.src, r.cited) for r in E.unresolved_citations(toy).collect()] == [("2", "zz")]
    names = as_dict(pub.vertices, "id", "name")
    assert names["2"] == "B" and names["6"] == "B"


@pytest.mark.parametrize("direction,want", [
    ("in", {"1": ["4", "6"], "2": ["1"], "3": ["1", "2", "2"], "4": ["4"]}),
    ("out", {"1": ["2", "3"], "2": ["3", "3"], "4": ["1", "4"], "6": ["1"]}),
    ("either", {"1": ["2", "3", "4", "6"], "2": ["1", "3", "3"], "3": ["1", "2", "2"], "4": ["1", "4", "4"],
                "6": ["1"]}),
])
def test_neighbors(spark, pub, direction, want):
    seeds = spark.createDataFrame([(str(i),) for i in range(1, 7)], "seed_id string")
    got = {}
    for r in neighbors(pub.edges, seeds, direction).collect():
        got.setdefault(r.seed_id, []).append(r.neighbor_id)
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize("slot", [100_000, 1])
def test_ranked_neighbors_order(spark, pub, slot, monkeypatch):
    monkeypatch.setattr("citeweave.operators.indexing.SLOT", slot)
    seeds = spark.createDataFrame([("1",), ("3",)], "seed_id string")
    rows = ranked_neighbors(pub.vertices, pub.edges, seeds, "either").collect()
    one = sorted((r for r in rows if r.seed_id == "1"), key=lambda r: r.rank)
    # by rank: 3 (1.893), 2 (1.023), 4 (0.847), 6 (0.487)
    assert [r.neighbor_id for r in one] == ["3", "2", "4", "6"]
    assert [r.rank for r in one] == [1, 2, 3, 4]
    three = sorted((r for r in rows if r.seed_id == "3"), key=lambda r: r.rank)
    assert [(r.neighbor_id, r.rank) for r in three] == [("1", 1), ("2", 2), ("2", 3)]


def test_journal_graph(toy):
    g = build_journal_graph(toy)
    assert sorted((r.src, r.dst, r.n) for r in g.edges.collect()) == [("J1", "J2", 3), ("J3", "J1", 1)]
    pr = as_dict(g.vertices, "id", "pr")
    assert pr["J1"] == pytest.approx(1.023513, abs=1e-6)
    assert pr["J2"] == pytest.approx(1.423237, abs=1e-6)
    assert pr["J3"] == pytest.approx(0.553250, abs=1e-6)


def test_cycle_graph(spark):
    v = spark.createDataFrame([(str(i),) for i in range(1, 7)], "id string")
    e = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "1"), ("4", "1"), ("5", "4")], "src string, dst string")
    res = pagerank(v, e)
    pr = as_dict(res.ranks, "id", "pr")
    want = {"1": 1.877240970242, "2": 1.770278531327, "3": 1.679459504596, "4": 0.323399698337,
            "5": 0.174810647749, "6": 0.174810647749}
    for k, w in want.items():
        assert pr[k] == pytest.approx(w, abs=1e-9)


def test_salted_layout_gives_same_ranks(toy, pub):
    salted = build_publication_graph(toy, edges_per_bucket=1)
    a = as_dict(pub.vertices, "id", "pr")
    b = as_dict(salted.vertices, "id", "pr")
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_max_rounds_raises(spark):
    v = spark.createDataFrame([("1",), ("2",)], "id string")
    e = spark.createDataFrame([("1", "2"), ("2", "1")], "src string, dst string")
    with pytest.raises(RuntimeError):
        pagerank(v, e, max_rounds=2)


def test_concurrent_builds_match(toy, pub):
    from citeweave.plans.graph import build_graphs

    p, j = build_graphs(toy)
    a = as_dict(p.vertices, "id", "pr")
    for k, want in PR.items():
        assert a[k] == pytest.approx(want, abs=1e-9)
    assert sorted((r.src, r.dst, r.n) for r in j.edges.collect()) == [("J1", "J2", 3), ("J3", "J1", 1)]
    assert as_dict(j.vertices, "id", "pr")["J2"] == pytest.approx(1.423237, abs=1e-6)


def test_rounds_count_only_rounds_with_messages(pub):
    # the last message round of the toy graph is 9 (the SQL recursion's last step)
    assert pub.rounds == 9
