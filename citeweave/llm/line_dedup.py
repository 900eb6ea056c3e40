"""Line deduplication.

Lines are exploded to hashes of their normal form, the documents of each hash
are counted, and each document gets back the list of hashes it has to lose.
Its text is then put together from the remaining lines in their order.

A line's key is the line with all ``[\\x20\\x09-\\x0D]`` stripped at both ends
and A-Z lower-cased. Keys are compared by 128 bits (two chained xxhash64).

Defined results: a null or empty text is one empty line, so nothing is lost
and the kept text is empty. Rows that repeat a doc_id count as one document.
A row without a doc_id is no document: its lines are not counted and stay.
A line repeated inside one document alone is no duplicate.
"""

from __future__ import annotations

import string

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import BLANKS, keep

LEAST_POINTS = 10
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_SEED = 42  # of Spark's xxhash64


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def line_table(docs: DataFrame, least_points: int = LEAST_POINTS) -> DataFrame:
    """(doc_id, h1, h2): the distinct line hashes of each row."""
    keys = F.filter(F.transform(F.split("text", "\n", -1), line_key), lambda k: F.char_length(k) >= least_points)
    hashes = F.array_distinct(F.transform(keys, lambda k: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(k, k).alias("h2"))))
    return docs.where("doc_id is not null").select("doc_id", F.explode(hashes).alias("h")).select("doc_id", "h.*")


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first_id) of the hashes found in at least ``min_docs`` documents."""
    first, last = F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    by = lines.groupBy("h1", "h2")
    if min_docs == 2:  # two documents differ in their ids: no need to count distinct ones
        found = by.agg(first, last).where("first_id < last_id")
    else:
        found = by.agg(first, F.count_distinct("doc_id").alias("n")).where(F.col("n") >= min_docs)
    return found.select("h1", "h2", "first_id")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def rebuild(texts: pa.Array, lost: pa.Array) -> pa.Array:
    kept, lines, dropped = [], [], []
    for text, out in zip(texts, lost):
        own = (text.as_py() or "").split("\n")
        lines.append(len(own))
        if out.is_valid and len(out):
            gone = {tuple(x.values()) for x in out.as_py()}
            rest = []
            for line in own:
                key = line.strip(BLANKS).translate(_LOWER).encode()
                h1 = xxhash.xxh64_intdigest(key, _SEED)
                if (_signed(h1), _signed(xxhash.xxh64_intdigest(key, h1))) not in gone:
                    rest.append(line)
            own = rest
        kept.append("\n".join(own))
        dropped.append(lines[-1] - len(own))
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                                      ["kept_text", "n_lines", "n_dropped"])


def line_dedup(docs: DataFrame, min_docs: int = 2, least_points: int = LEAST_POINTS, out: str = "line_dedup") -> DataFrame:
    """``docs`` with a struct column ``out``: kept_text, n_lines (before), n_dropped."""
    lines = keep(line_table(docs, least_points), "lines")
    shared = keep(shared_lines(lines, min_docs), "shared-lines")
    lost = (
        lines.join(shared, ["h1", "h2"]).where("doc_id <> first_id")
        .groupBy(F.col("doc_id").alias("__lost_id")).agg(F.collect_set(F.struct("h1", "h2")).alias("__lost"))
    )
    both = docs.join(lost, docs["doc_id"] == lost["__lost_id"], "left")
    return both.select(*[docs[c] for c in docs.columns], F.arrow_udf(rebuild, "struct<kept_text:string,n_lines:bigint,n_dropped:bigint>")(
        docs["text"], lost["__lost"]).alias(out))
