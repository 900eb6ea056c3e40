"""Publication records derived from the TPC-H style test tables.

The test tables carry no citation data, so parts and suppliers play
publications, and a part "cites" the part on the next line of the same order
and the supplier of its line. The derivation is
fixed (see FIXTURES.md section 3) so that Spark and the SQL oracle build the
same corpus. Only the four graph columns are produced; ``as_records`` pads
them to full publication records for the JSON round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators.indexing import WINDOW_ROWS, large_groups, lead_in_groups

from citeweave.sources.schema import PUBLICATION


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived_corpus(spark: SparkSession, sf_dir: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """(id, title, journalName, outCitations) from every part, supplier and
    line item.

    A part's record of one order cites the part on the next line of the order
    and the line's supplier; a next part whose key is divisible by 11 is cited
    by an id that the corpus lacks. A part without orders has one record with
    an empty list. A supplier with an even key cites the part of that
    key, the others cite nothing; suppliers whose nation keys leave the same modulo
    5 share a title. Parts whose key leaves 3 modulo
    100 have all their records twice.

    The line items are shuffled by order, which serves both the next line and the
    lists, and the lists once more by part. Orders of more than ``window_rows``
    lines get their next lines by position and their lists by a shuffle of their own.
    """
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    cites = lead_in_groups(lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "l_partkey", "nxt",
                           large_groups(lineitem, "l_orderkey", window_rows))
    # One record for each part and order: no list grows with a part's orders.
    lines = cites.groupBy("l_orderkey", F.col("l_partkey").alias("pk")).agg(F.collect_list(F.struct("l_linenumber", "nxt", "l_suppkey")).alias("lines"))

    def cited(x: Column) -> Column:
        return F.when(x["nxt"] % 11 == 0, F.concat(F.lit("x"), x["nxt"].cast("string"))).otherwise(x["nxt"].cast("string"))

    def supplied(x: Column) -> Column:
        return F.concat(F.lit("s"), x["l_suppkey"].cast("string"))

    def in_line_order(rows: Column, of) -> Column:
        pairs = F.sort_array(F.transform(rows, lambda x: F.struct(x["l_linenumber"].alias("at"), of(x).alias("c"))))
        return F.transform(pairs, lambda p: p["c"])

    # Most lists have one line and need no sorting.
    line = F.col("lines")[0]
    single = F.when(line["nxt"].isNull(), F.array(supplied(line))).otherwise(F.array(cited(line), supplied(line)))
    several = F.concat(in_line_order(F.filter("lines", lambda x: x["nxt"].isNotNull()), cited), in_line_order(F.col("lines"), supplied))
    lists = lines.select("pk", F.when(F.size("lines") == 1, single).otherwise(several).alias("oc"))
    empty: Column = F.array().cast("array<string>")
    records = part.join(lists, F.col("pk") == F.col("p_partkey"), "left").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.col("p_name"), F.lit(" "), (F.col("p_partkey") % 97).cast("string")).alias("title"),
        F.when(F.col("p_size") % 10 == 0, F.lit(""))
        .otherwise(F.concat(F.col("p_brand"), F.lit("/"), F.col("p_size").cast("string")))
        .alias("journalName"),
        F.coalesce("oc", empty).alias("outCitations"),
        F.explode(F.when(F.col("p_partkey") % 100 == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
    suppliers = supplier.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.concat(F.lit("Supplier of region "), (F.col("s_nationkey") % 5).cast("string")).alias("title"),
        F.when(F.col("s_nationkey") % 5 != 0, F.concat(F.lit("Nation/"), F.col("s_nationkey").cast("string"))).alias("journalName"),
        F.when(F.col("s_suppkey") % 2 == 0, F.array(F.col("s_suppkey").cast("string")))
        .otherwise(empty).alias("outCitations"),
    )
    return records.unionByName(suppliers)


def as_records(df: DataFrame) -> DataFrame:
    """Pad a frame to the full publication record layout (missing fields null)."""
    cols = []
    for field in PUBLICATION.fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)
