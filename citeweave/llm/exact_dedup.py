"""Exact deduplication by content-defined chunk recipes.

A text, freed of the blanks ``[\\x20\\x09-\\x0D]``, is cut where a rolling hash
of its last 32 bytes says so. Each chunk gets a 128-bit identifier. The chunk
contents travel once, already deduplicated by every map task, to verify that
no identifier stands for two contents; should one do, all identifiers are
taken anew under another seed. A text is then its ordered list of
identifiers, and only these lists are compared.

Defined results: a null text counts as empty, and all empty texts are equal.
Of equal texts the row with the most code points in its original text stays,
then the one with the smallest doc_id (a null doc_id comes last). Rows that
repeat a doc_id and its text are one document and get the same answer. Other
columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import BLANKS, keep, utf8

CHUNK_LEAST, CHUNK_MOST = 1024, 16384
#: A cut where the top bits of the rolling hash are zero: every 4 kB on average.
CUT_SHIFT = np.uint32(20)
GEAR = np.random.default_rng(20).integers(0, 2**32, 256, np.uint32)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; they depend on its bytes alone."""
    n = len(data)
    if n <= CHUNK_LEAST:
        return [n]
    h = GEAR[np.frombuffer(data, np.uint8)]
    for s in (1, 2, 4, 8, 16):
        older = h[:-s] << np.uint32(s)
        h[s:] += older
    marks = (np.flatnonzero(h >> CUT_SHIFT == 0) + 1).tolist()
    out, at = [], 0
    while n - at > CHUNK_LEAST:
        k = bisect_left(marks, at + CHUNK_LEAST)
        at = min(marks[k] if k < len(marks) else n, at + CHUNK_MOST, n)
        out.append(at)
    if at < n:
        out.append(n)
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def chunk_id(chunk: bytes, seed: int, id_bytes: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)[:id_bytes]


def _normal(texts: pa.Array):
    raw, offsets = utf8(texts)
    data = raw.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b].translate(None, BLANKS.encode())


def recipe_udf(seed: int, id_bytes: int):
    @F.arrow_udf("struct<text_sha256:string,recipe:binary>")
    def recipe(texts: pa.Array) -> pa.Array:
        sha, lists = [], []
        for data in _normal(texts):
            sha.append(hashlib.sha256(data).hexdigest())
            lists.append(b"".join(chunk_id(c, seed, id_bytes) for c in chunks(data)))
        return pa.StructArray.from_arrays([pa.array(sha, pa.string()), pa.array(lists, pa.binary())],
                                          ["text_sha256", "recipe"])
    return recipe


def chunk_table(docs: DataFrame, seed: int, id_bytes: int) -> DataFrame:
    """(id, content), a row for each chunk of each text."""
    def of(batches):
        for batch in batches:
            ids, contents, size = [], [], 0
            for data in _normal(batch.column(0)):
                for c in chunks(data):
                    ids.append(chunk_id(c, seed, id_bytes))
                    contents.append(c)
                    size += len(c)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(contents, pa.binary())], ["id", "content"])
                    ids, contents, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(contents, pa.binary())], ["id", "content"])
    return docs.select("text").mapInArrow(of, "id binary, content binary")


def verified_seed(docs: DataFrame, id_bytes: int = 16, tries: int = 64) -> int:
    """The first seed under which every identifier stands for one content."""
    for seed in range(tries):
        contents = chunk_table(docs, seed, id_bytes).distinct()
        shared = contents.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
        if not shared.take(1):
            return seed
    raise RuntimeError(f"no seed of {tries} gives distinct {8 * id_bytes}-bit identifiers")


def exact_dedup(docs: DataFrame, id_bytes: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_points for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    seed = verified_seed(docs, id_bytes)
    listed = keep(
        docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_points"),
                    recipe_udf(seed, id_bytes)("text").alias("r")).select("doc_id", "n_points", "r.*"),
        "recipes",
    )
    best = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"))).alias("best")
    # Written, so that both sides of the join come from exchanges of their own
    # and a group with a third of all rows is split.
    groups = keep(listed.groupBy("recipe").agg(F.count("*").alias("group_size"), best)
                  .select("recipe", "group_size", F.col("best.id").alias("keep_id")), "groups")
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_points")
