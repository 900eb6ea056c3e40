"""Degrees and vertex attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_degrees(edges: DataFrame) -> DataFrame:
    """(id, in_deg) for vertices with at least one in-edge; parallel edges
    and self-loops count."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_deg"))


def out_degrees(edges: DataFrame) -> DataFrame:
    """(id, out_deg) for vertices with at least one out-edge."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_deg"))


def attach_attributes(vertices: DataFrame, edges: DataFrame, ranks: DataFrame, also: list[str] | None = None) -> DataFrame:
    """(id, name, in_deg, out_deg, pr) and the columns ``also`` of the vertices;
    missing degrees and ranks become 0.

    All three joins are on ``id``; Spark shuffles each input once on that key
    and chains the joins without re-partitioning.
    """
    return (
        vertices.select("id", "name", *(also or []))
        .join(in_degrees(edges), "id", "left")
        .join(out_degrees(edges), "id", "left")
        .join(ranks.select("id", "pr"), "id", "left")
        .select(
            "id",
            "name",
            F.coalesce("in_deg", F.lit(0)).cast("bigint").alias("in_deg"),
            F.coalesce("out_deg", F.lit(0)).cast("bigint").alias("out_deg"),
            F.coalesce("pr", F.lit(0.0)).alias("pr"),
            *(also or []),
        )
    )


def attach_ranks(vertices: DataFrame, ranked: DataFrame) -> DataFrame:
    """The vertices with in_deg, out_deg and pr of ``ranked`` (``PageRankResult.ranks``,
    which has the degrees from its edge layout): one join, no look at the edges."""
    return vertices.join(ranked.select(F.col("id").alias("_of"), "in_deg", "out_deg", "pr"), F.col("id") == F.col("_of"), "left").select(
        *vertices.columns, F.coalesce("in_deg", F.lit(0)).cast("bigint").alias("in_deg"),
        F.coalesce("out_deg", F.lit(0)).cast("bigint").alias("out_deg"), F.coalesce("pr", F.lit(0.0)).alias("pr"))


def with_default_vertices(vertices: DataFrame, edges: DataFrame, default: str = "nocitation") -> DataFrame:
    """(id, name) for every edge endpoint; an endpoint without a vertex row
    gets the default attribute."""
    # Fixed value: the default vertex attribute of graph assembly is "nocitation".
    endpoints = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()
    return endpoints.join(vertices.select("id", "name"), "id", "left").select(
        "id", F.coalesce("name", F.lit(default)).alias("name")
    )
