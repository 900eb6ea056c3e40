"""PageRank against a brute-force implementation on random small graphs
(parallel edges, self-loops, sinks and isolated vertices included)."""

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from citeweave.operators.pagerank import pagerank


def brute_force(n, edges, tol=1e-4, reset=0.15):
    k = Counter(s for s, _ in edges)
    rank = {v: reset for v in range(n)}
    delta = dict(rank)
    while True:
        msgs = defaultdict(float)
        for s, d in edges:
            if delta.get(s, 0.0) > tol:
                msgs[d] += delta[s] / k[s]
        if not msgs:
            break
        delta = {d: (1 - reset) * m for d, m in msgs.items()}
        for d, x in delta.items():
            rank[d] += x
    total = sum(rank.values())
    return {v: r * n / total for v, r in rank.items()}


graphs = st.integers(min_value=1, max_value=12).flatmap(
    lambda n: st.tuples(st.just(n), st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1)), max_size=40)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(graph=graphs, salted=st.booleans())
def test_matches_brute_force(spark, graph, salted):
    n, edges = graph
    v = spark.createDataFrame([(i,) for i in range(n)], "id bigint")
    e = spark.createDataFrame(edges, "src bigint, dst bigint") if edges else \
        spark.createDataFrame([], "src bigint, dst bigint")
    got = {r.id: r.pr for r in pagerank(v, e, edges_per_bucket=2 if salted else 1_000_000).ranks.collect()}
    want = brute_force(n, edges)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9)
