"""JSON-lines publication scan, malformed-record quarantine and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeweave.session import keep
from citeweave.sources.schema import CORRUPT_COLUMN, GRAPH_COLUMNS, PUBLICATION, with_corrupt_column

MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")


def parse_lines(lines: DataFrame) -> DataFrame:
    """(record, reason, recovered_id, line) for text lines (column ``value``).

    Every line is parsed against the full schema, so a bad value in any field
    shows, also in one that nobody selects. ``reason`` is null for a good
    record, 'malformed' for a line that does not parse, 'missing_id' for a
    record without an id. The line itself is kept whatever the reason. Blank
    lines are no records.
    """
    parsed = F.from_json("value", with_corrupt_column(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    rows = lines.where(F.trim("value") != "").select(parsed.alias("record"), F.col("value").alias("line"))
    bad = F.col("record").isNull() | F.col(f"record.{CORRUPT_COLUMN}").isNotNull()
    reason = F.when(bad, F.lit("malformed")).when(F.col("record.id").isNull(), F.lit("missing_id"))
    seen = F.when(bad, F.regexp_extract("line", r'"id"\s*:\s*"([^"]*)"', 1))
    return rows.select("record", reason.alias("reason"), seen.alias("recovered_id"), "line")


def read_publications(spark: SparkSession, path: str, mode: str = "FAILFAST",
                      columns: list[str] | None = GRAPH_COLUMNS) -> DataFrame:
    """Scan JSON-lines publication records with the fixed schema.

    ``FAILFAST`` fails the job on the first line that does not parse against
    the full schema or has no id, as a strict record parser would.
    ``PERMISSIVE`` and ``DROPMALFORMED`` leave such lines out; use
    ``scan_with_quarantine`` to see them. ``columns``: ``None`` keeps all 19.
    """
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    rows = parse_lines(spark.read.text(path))
    if mode == "FAILFAST":
        stop = F.raise_error(F.concat(F.col("reason"), F.lit(" record: "), F.substring("line", 1, 200)))
        rows = rows.where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(stop.cast("boolean")))
    else:
        rows = rows.where(F.col("reason").isNull())
    names = columns if columns is not None else PUBLICATION.fieldNames()
    return rows.select(*[F.col(f"record.{c}").alias(c) for c in names])


def scan_with_quarantine(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Split a JSON-lines scan into (good records, quarantined lines).

    The quarantine has ``reason`` ('malformed' or 'missing_id'), the id
    recovered from the text of a malformed line where it is visible, and the
    raw line. Every line is parsed once and goes to one of two partitions of one
    output: good records with the columns of the graphs, the others with their line.
    """
    good, bad = F.col("reason").isNull(), F.col("reason").isNotNull()
    rows = parse_lines(spark.read.text(path)).select(
        *[F.when(good, F.col(f"record.{c}")).alias(c) for c in GRAPH_COLUMNS],
        "reason", "recovered_id", F.when(bad, F.col("line")).alias("line"), bad.alias("quarantined"))
    kept = keep(rows, "parsed-lines", partition_by=["quarantined"])
    return kept.where(~F.col("quarantined")).select(*GRAPH_COLUMNS), \
        kept.where("quarantined").select("reason", "recovered_id", "line")


def split_parsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, quarantined lines) of parsed lines."""
    good = rows.where(F.col("reason").isNull()).select(*[F.col(f"record.{c}").alias(c) for c in GRAPH_COLUMNS])
    return good, rows.where(F.col("reason").isNotNull()).select("reason", "recovered_id", "line")


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON text line per record, as the scan expects it."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_json_lines(df: DataFrame, path: str) -> str:
    """Distributed write of records as JSON lines (one file per partition)."""
    df.write.mode("overwrite").json(path)
    return path


#: How values are set apart, so that a table reads back as it was written: quotes are doubled,
#: an empty string is quoted and a null is not.
CSV_FORM = {"header": "true", "escape": '"', "emptyValue": '""', "nullValue": "", "lineSep": "\n",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV sink with a header. ``single_file`` coalesces to one file and is
    meant for small reports only (for example the influence report of a few seeds)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_FORM).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``write_csv`` wrote, in ``schema``; a value that does not fit it fails the job."""
    # A missing field is null by itself; were "" named as null, quoted empty strings would be too.
    options = {k: v for k, v in CSV_FORM.items() if k not in ("emptyValue", "lineSep")} | {"nullValue": "\0"}
    return spark.read.schema(schema).options(mode="FAILFAST", multiLine="true", emptyValue="", **options).csv(path)
