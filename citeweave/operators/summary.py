"""Graph summaries: counts, distinct rank values, highest-degree vertices.

Ranks are compared at 6 decimals: two engines summing the same deltas in a
different order agree to about 1e-15, not bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK_DECIMALS = 6


def rounded_pr(col: str = "pr"):
    return F.round(F.col(col), RANK_DECIMALS)


def graph_summary(graph_vertices: DataFrame) -> DataFrame:
    """One row: vertices, edges, vertices with in-edges / out-edges, distinct
    rank values, max and min rank. One pass over the attributed vertices
    (the edge count is the sum of out-degrees)."""
    return graph_vertices.agg(
        F.count("*").alias("n_vertices"),
        F.coalesce(F.sum("out_deg"), F.lit(0)).cast("bigint").alias("n_edges"),
        F.count(F.when(F.col("in_deg") > 0, 1)).alias("n_with_in"),
        F.count(F.when(F.col("out_deg") > 0, 1)).alias("n_with_out"),
        F.count_distinct(rounded_pr()).alias("n_distinct_pr"),
        F.max(rounded_pr()).alias("max_pr"),
        F.min(rounded_pr()).alias("min_pr"),
    )


def rank_values(graph_vertices: DataFrame) -> DataFrame:
    """Distinct rank values (rounded)."""
    return graph_vertices.select(rounded_pr().alias("pr")).distinct()


def max_degree_vertices(graph_vertices: DataFrame) -> DataFrame:
    """(kind, id, degree) for kind in in/out/total: the vertex with the
    highest degree, ties to the smallest id. A global aggregate with partial
    aggregation; nothing is sorted."""
    def best(deg):
        key = F.struct((-deg).alias("d"), F.col("id").alias("i"))
        return F.min_by(F.struct(F.col("id").alias("id"), deg.alias("degree")), key)

    total = F.col("in_deg") + F.col("out_deg")
    row = graph_vertices.agg(
        best(F.col("in_deg")).alias("in"),
        best(F.col("out_deg")).alias("out"),
        best(total).alias("total"),
    )
    return row.select(
        F.explode(F.array(
            F.struct(F.lit("in").alias("kind"), F.col("in.id").alias("id"), F.col("in.degree").alias("degree")),
            F.struct(F.lit("out").alias("kind"), F.col("out.id").alias("id"), F.col("out.degree").alias("degree")),
            F.struct(F.lit("total").alias("kind"), F.col("total.id").alias("id"), F.col("total.degree").alias("degree")),
        )).alias("r")
    ).select("r.kind", "r.id", F.col("r.degree").cast("bigint").alias("degree"))
