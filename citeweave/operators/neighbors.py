"""Neighbourhoods ranked by PageRank: the "which connected papers matter
most?" questions, for one name or for many seeds in one job.

Directions: ``in`` (vertices citing the seed), ``out`` (vertices the seed
cites), ``either`` (both; a self-loop is listed twice). A neighbour appears
once per parallel edge.

Ordering: rank (rounded to 6 decimals) descending, then id ascending, so
ties are broken the same way everywhere. A name lookup returns every vertex
carrying that name (names repeat in real corpora), keyed by ``seed_id``; an
unknown name gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.operators.indexing import dense_index, rank_within
from citeweave.operators.summary import rounded_pr

DIRECTIONS = ("in", "out", "either")
# Seeds tables up to this many rows (by construction, e.g. top-k) are broadcast.
BROADCAST_SEEDS = 100_000


def _seed_side(seeds: DataFrame, bound: int | None) -> DataFrame:
    s = seeds.select("seed_id")
    return F.broadcast(s) if bound is not None and bound <= BROADCAST_SEEDS else s


def with_position(graph_vertices: DataFrame) -> DataFrame:
    """The vertices with ``position``, their place (from 0) in the order of
    rounded rank and id. Built graphs have it; other tables get it by a
    sort over all vertices."""
    if "position" in graph_vertices.columns:
        return graph_vertices
    return dense_index(graph_vertices, [rounded_pr().desc(), F.col("id").asc()], name="position")


def neighbors(edges: DataFrame, seeds: DataFrame, direction: str = "in", seeds_bound: int | None = None) -> DataFrame:
    """(seed_id, neighbor_id, via): one row per edge touching a seed."""
    direction = direction.lower()
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    s = _seed_side(seeds, seeds_bound)
    parts = []
    if direction in ("in", "either"):
        parts.append(edges.join(s, F.col("dst") == F.col("seed_id"))
                     .select("seed_id", F.col("src").alias("neighbor_id"), F.lit("in").alias("via")))
    if direction in ("out", "either"):
        parts.append(edges.join(s, F.col("src") == F.col("seed_id"))
                     .select("seed_id", F.col("dst").alias("neighbor_id"), F.lit("out").alias("via")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def vertices_by_name(graph_vertices: DataFrame, names: DataFrame, names_bound: int | None = None) -> DataFrame:
    """Every vertex whose name equals one of ``names`` (column ``name``),
    as (seed_name, seed_id, ...attributes)."""
    n = names.select(F.col("name").alias("seed_name")).distinct()
    if names_bound is not None and names_bound <= BROADCAST_SEEDS:
        n = F.broadcast(n)
    return graph_vertices.join(n, F.col("name") == F.col("seed_name")).withColumnRenamed("id", "seed_id")


def ranked_neighbors(graph_vertices: DataFrame, edges: DataFrame, seeds: DataFrame, direction: str = "in",
                     seeds_bound: int | None = None) -> DataFrame:
    """(seed_id, rank, neighbor_id, name, in_deg, out_deg, pr, via) with
    ``rank`` 1 for the most influential neighbour of each seed."""
    nb = neighbors(edges, seeds, direction, seeds_bound)
    attrs = with_position(graph_vertices).select(
        F.col("id").alias("neighbor_id"), "name", "in_deg", "out_deg", rounded_pr().alias("pr"), "position"
    )
    ranked = rank_within(nb.join(attrs, "neighbor_id"), "seed_id", "position", ["position", "via"])
    return ranked.select("seed_id", "rank", "neighbor_id", "name", "in_deg", "out_deg", "pr", "via")


def influential_by_name(graph_vertices: DataFrame, edges: DataFrame, names: DataFrame, direction: str = "in",
                        names_bound: int | None = None) -> DataFrame:
    """Ranked neighbours of every vertex named in ``names``. A name may match
    any number of vertices, so the seed table is not assumed to be small."""
    seeds = vertices_by_name(graph_vertices, names, names_bound).select("seed_name", "seed_id")
    ranked = ranked_neighbors(graph_vertices, edges, seeds, direction)
    return seeds.join(ranked, "seed_id").select("seed_name", *ranked.columns)


def top_k(graph_vertices: DataFrame, k: int) -> DataFrame:
    """The k highest-ranked vertices with their position (1-based).

    A built graph knows every vertex's position, so this is a filter. For
    other tables orderBy + limit plans as TakeOrderedAndProject: each task keeps
    its own k best and the driver merges k rows per task. The position window
    then runs over at most k rows.
    """
    if "position" in graph_vertices.columns:
        return graph_vertices.where(F.col("position") < k).select(
            "id", "name", "in_deg", "out_deg", rounded_pr().alias("pr"), (F.col("position") + 1).alias("position"))
    best = graph_vertices.select("id", "name", "in_deg", "out_deg", rounded_pr().alias("pr")) \
        .orderBy(F.col("pr").desc(), F.col("id").asc()).limit(k)
    position = F.row_number().over(Window.orderBy(F.col("pr").desc(), F.col("id").asc())).cast("bigint")
    return best.withColumn("position", position)


def influence_report(graph_vertices: DataFrame, edges: DataFrame, k: int, direction: str = "in") -> DataFrame:
    """For each of the k highest-ranked vertices, all its neighbours ranked:
    one distributed job instead of one lookup per seed.
    (seed_position, seed_id, seed_name, rank, neighbor_id, name, in_deg,
    out_deg, pr, via)."""
    seeds = top_k(graph_vertices, k).select(
        F.col("position").alias("seed_position"), F.col("id").alias("seed_id"), F.col("name").alias("seed_name")
    )
    ranked = ranked_neighbors(graph_vertices, edges, seeds, direction, seeds_bound=k)
    known = F.broadcast(seeds) if k <= BROADCAST_SEEDS else seeds
    return known.join(ranked, "seed_id").select(
        "seed_position", "seed_id", "seed_name", "rank", "neighbor_id", "name", "in_deg", "out_deg", "pr", "via"
    )
