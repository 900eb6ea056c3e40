"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.session import scratch_path

#: The characters that ``[\x20\x09-\x0D]`` names.
BLANKS = " \t\n\x0b\f\r"
#: Text handled at once inside a Python task, in bytes. A longer text is handled alone.
SLICE_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: the lineage is
    cut, and a lost executor costs nothing that was already written."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and the n + 1 offsets; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        wide = np.int64
    else:
        wide = np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts in order, as (bytes, offsets) of at most ``limit`` bytes or of one text."""
    raw, offsets = utf8(texts)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def give_back() -> None:
    """Return freed memory of this Python worker to the system, where the C library can."""
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    pa.default_memory_pool().release_unused()
