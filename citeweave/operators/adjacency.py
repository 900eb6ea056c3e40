"""Edges of a ranked graph written for lookups.

A built graph knows every vertex's ``position`` in the order of rank. Its
edges are written twice as pairs of positions, sorted by the cited vertex
(``incoming``) and by the citing one (``outgoing``). A question about the k
highest-ranked vertices is then ``position < k`` on a sorted column: row groups
outside are pruned by their minimum and maximum. A question about other seeds
is a join on bigints; seeds with a proven bound are broadcast, so the edges are
scanned, two columns of them, and not shuffled. Since a neighbour's number is
its place in the ranking, neighbours are ordered before their attributes are
attached.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.operators.indexing import rank_within
from citeweave.operators.summary import rounded_pr
from citeweave.session import keep

DIRECTIONS = ("in", "out", "either")
# Seeds tables up to this many rows (by construction, e.g. top-k) are broadcast.
BROADCAST_SEEDS = 100_000


@dataclass
class Adjacency:
    incoming: DataFrame  # (seed, neighbor): cited, citing; sorted by both
    outgoing: DataFrame  # (seed, neighbor): citing, cited; sorted by both


@dataclass
class Seeds:
    rows: DataFrame  # seed_id, seed_position and any other columns
    bound: int | None = None  # most rows it can have, if that is known
    prefix: int | None = None  # k if the seeds are the k highest-ranked vertices

    def table(self, *columns: str) -> DataFrame:
        rows = self.rows.select(*columns).distinct() if columns else self.rows
        return F.broadcast(rows) if self.bound is not None and self.bound <= BROADCAST_SEEDS else rows

    def pruned(self, edges: DataFrame) -> DataFrame:
        return edges if self.prefix is None else edges.where(F.col("seed") < F.lit(self.prefix).cast("bigint"))


def adjacency(edges: DataFrame, positions: DataFrame, name: str) -> Adjacency:
    """``edges`` (src_node, dst_node, one row per edge) by the positions (node, position) of their ends."""
    src = positions.select(F.col("node").alias("src_node"), F.col("position").alias("src"))
    dst = positions.select(F.col("node").alias("dst_node"), F.col("position").alias("dst"))
    pairs = keep(edges.select("src_node", "dst_node").join(src, "src_node").join(dst, "dst_node").select("src", "dst"), f"{name}-pairs")

    def sorted_by(seed: str, neighbor: str) -> DataFrame:
        # The second key spreads the edges of one vertex over several ranges.
        order = ["seed", "neighbor"]
        out = pairs.select(F.col(seed).alias("seed"), F.col(neighbor).alias("neighbor"))
        return keep(out.repartitionByRange(*order).sortWithinPartitions(*order), f"{name}-by-{seed}")

    with ThreadPoolExecutor(max_workers=2, thread_name_prefix="citeweave-adjacency") as pool:
        incoming, outgoing = pool.submit(sorted_by, "dst", "src"), pool.submit(sorted_by, "src", "dst")
        result = Adjacency(incoming.result(), outgoing.result())
    result.incoming._kept = [pairs]
    return result


def touching(adjacent: Adjacency, seeds: Seeds, direction: str) -> DataFrame:
    """(seed_position, neighbor, via): one row per edge touching a seed."""
    direction = direction.lower()
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    parts = [seeds.pruned(edges).join(seeds.table("seed_position"), F.col("seed") == F.col("seed_position"))
             .select("seed_position", "neighbor", F.lit(way).alias("via"))
             for way, edges in (("in", adjacent.incoming), ("out", adjacent.outgoing)) if direction in (way, "either")]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _attributes(vertices: DataFrame, *columns: Column | str) -> DataFrame:
    return vertices.select(F.col("position").alias("_place"), *columns)


def neighbor_ids(vertices: DataFrame, adjacent: Adjacency, seeds: Seeds, direction: str) -> DataFrame:
    """(seed_id, neighbor_id, via)"""
    found = touching(adjacent, seeds, direction)
    return found.join(_attributes(vertices, F.col("id").alias("neighbor_id")), F.col("neighbor") == F.col("_place")) \
        .join(seeds.table(), "seed_position").select("seed_id", "neighbor_id", "via")


def ranked(vertices: DataFrame, adjacent: Adjacency, seeds: Seeds, direction: str, *also: str) -> DataFrame:
    """(*also: other columns of the seeds, seed_id, rank, neighbor_id, name, in_deg, out_deg, pr, via): a seed's neighbours by descending
    rank, then id. They are numbered by their positions, then get their and the seeds' attributes."""
    found = rank_within(touching(adjacent, seeds, direction), "seed_position", "neighbor", ["neighbor", "via"])
    attributes = _attributes(vertices, F.col("id").alias("neighbor_id"), "name", "in_deg", "out_deg", rounded_pr().alias("pr"))
    return found.join(attributes, F.col("neighbor") == F.col("_place")).join(seeds.table(), "seed_position") \
        .select(*also, "seed_id", "rank", "neighbor_id", "name", "in_deg", "out_deg", "pr", "via")
