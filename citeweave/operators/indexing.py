"""Global positions over a total order, without a single-partition window.

``dense_index`` is the DataFrame form of sort-then-zipWithIndex:

  1. range-partition on the sort key plus a unique tie-breaker, sort inside
     each partition (the sampled RangePartitioner then spreads even a third of
     the rows sharing one key) and write the rows, nothing else, as Parquet;
  2. the files' footers say how many rows each holds (a count by file reads no
     column): one row per file, turned into start offsets;
  3. position = offset of the file + the row's index in its file, which the
     reader supplies.

So the data is sorted and written in one job and not scanned again.

``rank_within`` ranks rows inside groups that may each hold a third of all
rows, and ``lead_in_order`` looks at the next row of such groups; neither sorts
a group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.session import keep

# Positions of one slot in ``rank_within``.
SLOT = 100_000
# Rows that a window sorts as one group; ``lead_in_groups`` takes larger ones by position.
WINDOW_ROWS = 100_000
# Sums of groups that ``large_groups`` looks at before it counts any group.
GROUP_SUMS = 1 << 16


def _as_sort(c) -> Column:
    return F.col(c).asc() if isinstance(c, str) else c


def dense_index(df: DataFrame, order: list, name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Add a 0-based bigint position ``name`` following ``order`` (a list of
    column names or sort expressions; make it a total order for a
    deterministic result). ``partitions``: range partitions and files, by default
    the session's number of shuffle partitions."""
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A unique last key: rows equal on ``order`` (copies, parallel edges) can
    # still be spread over several range partitions.
    sort_cols = [_as_sort(c) for c in order] + [F.col("_tie").asc()]
    rows = keep(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .drop("_tie"),
        "positions",
    )
    counts = rows.groupBy(F.col("_metadata.file_name").alias("_file")).agg(F.count("*").alias("_n"))
    # One row per file: a single-partition window here is bounded by the number
    # of files, not by the data. Files are named by partition, then by place in it.
    # Materialised once, so every consumer of the positions reuses it.
    part = F.regexp_extract("_file", "part-([0-9]+)", 1).cast("bigint")
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")), "offsets")
    placed = rows.select("*", F.col("_metadata.file_name").alias("_of"), F.col("_metadata.row_index").alias("_at"))
    out = placed.join(F.broadcast(offsets), F.col("_of") == F.col("_file")) \
        .select(*df.columns, (F.col("_off") + F.col("_at")).cast("bigint").alias(name))
    out._kept = [rows, offsets]
    return out


def rank_within(df: DataFrame, group: str, position: str, order: list, name: str = "rank") -> DataFrame:
    """Add a 1-based ``name`` ranking rows inside each ``group`` by ``order``.

    ``position`` is a bigint column that never falls along ``order`` (the
    place of a row's vertex in the graph's ranking, for example). Rows are
    ranked inside (group, slot), a slot being SLOT positions, and the rows of
    the group's earlier slots are added. So a group of any size is spread over
    as many tasks as it has slots, every size takes this one plan, a null
    group is a group like others, and nothing runs before the result is asked
    for. The slot sizes come from the ranked rows themselves, whose exchange
    is reused.
    """
    slot = F.call_function("div", F.col(position), F.lit(SLOT))
    inside = Window.partitionBy(group, "_slot").orderBy(*[_as_sort(c) for c in order])
    ranked = df.withColumn("_slot", slot).withColumn("_row", F.row_number().over(inside))
    sizes = ranked.groupBy(F.col(group).alias("_of"), F.col("_slot").alias("_at")).agg(F.max("_row").alias("_n"))
    earlier = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_of", "_at", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        ranked.join(before, F.col(group).eqNullSafe(F.col("_of")) & F.col("_slot").eqNullSafe(F.col("_at")))
        .withColumn(name, (F.col("_before") + F.col("_row")).cast("bigint"))
        .drop("_slot", "_row", "_of", "_at", "_before")
    )


def lead_in_order(df: DataFrame, group: str, order: list, value: str, name: str) -> DataFrame:
    """``lead(value) over (partition by group order by order)`` that no large
    group can stall.

    Rows get global positions on (group, order) and each row is joined to the
    row one position later, kept only when it belongs to the same group; an
    equi-join on a unique position has no hot key, however large one group is.
    """
    indexed = dense_index(df, [group] + list(order), name="_pos")
    following = indexed.select((F.col("_pos") - 1).alias("_pos"), F.col(group).alias("_next_group"),
                               F.col(value).alias("_next_value"))
    return indexed.join(following, "_pos", "left").select(
        *df.columns,
        F.when(F.col("_next_group").eqNullSafe(F.col(group)), F.col("_next_value")).alias(name),
    )


def large_groups(df: DataFrame, group: str, rows: int = WINDOW_ROWS) -> DataFrame | None:
    """The values of ``group`` with more than ``rows`` rows, as kept rows, or None if there are
    none. At most one for each ``rows`` rows of the input."""
    # No group is larger than the sum that it is part of, and the sums are few.
    part = F.pmod(F.xxhash64(group), F.lit(GROUP_SUMS))
    sums = keep(df.groupBy(part.alias("_sum")).count().where(F.col("count") > rows).select("_sum"), "group-sums")
    if sums.isEmpty():
        return None
    found = keep(df.withColumn("_sum", part).join(F.broadcast(sums), "_sum", "left_semi")
                 .groupBy(group).count().where(F.col("count") > rows).select(group), "large-groups")
    return None if found.isEmpty() else found


def lead_in_groups(df: DataFrame, group: str, order: list, value: str, name: str, large: DataFrame | None) -> DataFrame:
    """``lead_in_order`` for groups that are small but for those in ``large`` (see
    ``large_groups``): the small ones take one shuffle, whose partitioning on
    ``group`` the caller can go on with, and only the large ones go by position."""
    window = Window.partitionBy(group).orderBy(*[_as_sort(c) for c in order])
    if large is None:
        return df.withColumn(name, F.lead(value).over(window))
    is_large = F.col(group).eqNullSafe(F.col("_large"))
    large = F.broadcast(large.select(F.col(group).alias("_large")))
    small = df.join(large, is_large, "left_anti").withColumn(name, F.lead(value).over(window))
    return small.unionByName(lead_in_order(df.join(large, is_large, "left_semi"), group, order, value, name))
