
import numpy as np
import pytest

from citeweave.llm import cover_tree as ct
from citeweave.llm.queries import QUERIES, SQL
from conftest import SF



def clustered(rng, n, dim, sizes=(), spread=0.07):
    """Random unit vectors, and clusters of near copies of some of them."""
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    parts = [x]
    for size in sizes:
        y = x[rng.integers(n)] + rng.normal(size=(size, dim)) * spread / np.sqrt(dim)
        parts.append(y)
    return np.concatenate(parts)


def brute(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) of rows of (vec_id, vector, label), all pairs compared in doubles."""
    fine = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine[i] = (label, np.array(v, np.float64))
    ids = sorted(fine)
    near = {i: {i} for i in ids}
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            (k, x), (m, y) = fine[i], fine[j]
            if k == m and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    component = {}
    for i in ids:
        if i not in component:
            seen, waiting = {i}, [i]
            while waiting:
                for j in near[waiting.pop()] - seen:
                    seen.add(j)
                    waiting.append(j)
            component |= dict.fromkeys(seen, min(seen))
    return sorted((i, len(near[i]) - 1 if i in near else 0, component.get(i, i), component.get(i, i) == i) for i, _, _ in rows)


def as_table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, k, f"x{i}", "y") for i, v, k in rows], f"vec_id bigint, embedding array<{kind}>, label int, rep string, digest string")


def answer(df):
    return sorted(tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


def single(x):
    return np.asarray(x, np.float32).astype(float).tolist()


@pytest.mark.parametrize("seed", range(4))
def test_trees_cover_their_points(seed):
    rng = np.random.default_rng(seed)
    points = ct.unit(clustered(rng, 150, 3 + seed * 20, (30, 60), 0.2))
    order, nodes, radii = ct.build(points)
    assert sorted(order.tolist()) == list(range(len(points)))
    p = points[order]
    for (a, b, c, d), r in zip(nodes.tolist(), radii):
        assert ct.distance(p[a:b] @ p[a]).max() <= r + 1e-9 or b - a == 1
        if c < d:  # children divide their parent, and its centre is one of theirs
            assert nodes[c, 0] == a and nodes[d - 1, 1] == b and (nodes[c:d - 1, 1] == nodes[c + 1:d, 0]).all()


@pytest.mark.parametrize("seed", range(6))
def test_traversal_finds_every_link(seed):
    rng = np.random.default_rng(seed)
    x = clustered(rng, 300, (2, 3, 8, 64, 64, 64)[seed], (200, 300, 5), (0.1, 0.3, 0.15, 0.14, 0.01, 0.3)[seed])
    sides = []
    for k in range(2):
        own = x[k::2].astype(np.float32)
        order, nodes, radii = ct.build(ct.unit(own))
        sides.append({"points": ct.unit(own[order]), "vectors": own[order], "nodes": nodes, "radii": radii, "weights": rng.integers(1, 4, len(own))})
    a, b = sides
    both = np.concatenate([a["points"], b["points"]])
    for first, second, cosine in ((a, b, a["points"] @ b["points"].T), (a, a, a["points"] @ a["points"].T)):
        linked = cosine >= 0.98
        if first is second:
            np.fill_diagonal(linked, False)
        found = ct.Links(first, second, 0.98)
        assert (found.count[0] == linked @ second["weights"]).all()
        if first is not second:
            assert (found.count[1] == first["weights"] @ linked).all()
        labels = np.arange(len(both) if first is not second else len(a["points"]))
        i, j = np.nonzero(linked)
        j = j + found.base
        while True:
            least = labels.copy()
            np.minimum.at(least, i, labels[j])
            np.minimum.at(least, j, labels[i])
            if (least == labels).all():
                break
            labels = least
        assert (found.forest.label == labels).all()


@pytest.mark.parametrize("kind,block", [("float", 4096), ("double", 4096), ("float", 40)])
def test_links_equal_brute_force(spark, kind, block):
    """Also with many small blocks, so that groups are dealt out by pivots and crowded regions by hash."""
    rng = np.random.default_rng(3)
    x = clustered(rng, 250, 16, (60, 40, 3, 2), 0.13)
    rows = [(int(i), single(v), int(k)) for i, v, k in zip(rng.permutation(len(x)), x, rng.choice([0, 0, 0, 1, 2], len(x)))]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(50)]  # many copies of one vector
    assert answer(ct.embedding_links(as_table(spark, rows, kind), block=block)) == brute(rows)


def test_rows_of_all_kinds(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1),
            (9, [1.0, float("nan"), 3.0], 1), (10, [float("inf"), 2.0, 3.0], 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.0, 6.0], 1), (13, [-1.0, -2.0, -3.0], 1),
            (14, [3.4028234e38, 0.0, 0.0], 3), (15, [1e-30, 0.0, 0.0], 3), (16, [1.0, -0.0, 0.0], 3), (17, [1.0, 0.0, 0.0], 3), (18, [0.0, 1.0], None)]
    assert answer(ct.embedding_links(as_table(spark, rows, "double"))) == brute(rows)
    again = ct.embedding_links(as_table(spark, rows + [(1, one, 1), (None, one, 1), (None, None, None)], "double")).collect()
    assert sorted(tuple(r) for r in again if r.vec_id is not None) == sorted(brute(rows) + [r for r in brute(rows) if r[0] == 1])
    assert [tuple(r) for r in again if r.vec_id is None] == [(None, 0, None, True)] * 2
    assert ct.embedding_links(as_table(spark, [])).collect() == []


def test_a_tie_at_the_threshold_links(spark):
    """7-24-25: a cosine of exactly 24 / 25."""
    rows = [(1, [1.0, 0.0], 0), (2, [24.0, 7.0], 0), (3, [24.0, 7.000001], 0)]
    found = answer(ct.embedding_links(as_table(spark, rows, "double"), threshold=0.96))
    assert found == [(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False)]


def test_forests_not_links_leave_the_tasks(spark):
    """A dense group of n vectors has n * n links; what the tasks write grows with n."""
    rng = np.random.default_rng(5)
    rows = [(int(i), single(v), 0) for i, v in enumerate(clustered(rng, 1, 8, (1500,), 0.02))]
    table = as_table(spark, rows)
    points = ct.point_rows(table).selectExpr("1L as grp", "digest", "vec_id as rep", "1L as weight", "vector")
    trees = ct.blocks(points, np.dtype("<f4"), 500)
    pairs = ct.block_pairs(trees, 0.98)
    n_blocks, n_pairs = trees.count(), pairs.count()
    assert n_blocks >= 3 and n_pairs <= n_blocks * (n_blocks + 1) // 2
    written = ct.linked_points(trees, pairs, np.dtype("<f4"), 0.98).count()
    assert written <= 4 * len(rows) * n_blocks < len(rows) ** 2 // 10
    assert {r[1] for r in answer(ct.embedding_links(table, block=500))} == {1500}


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert answer(QUERIES["op11_cover_tree"](spark, SF)) == sorted(con.execute(f"select vec_id, n_links, component_id, kept from ({SQL['op11_cover_tree']})").fetchall())
