"""Corpus preparation: five of the document operators in a row.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``docs``, whatever else these
are. ``run`` writes every stage's result before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import quality
from citeweave.llm.byte_bpe import byte_bpe
from citeweave.llm.common import id_bucket, keep, table
from citeweave.llm.decontaminate import leaked_items
from citeweave.llm.line_dedup import line_dedup
from citeweave.llm.near_dedup import near_dedup

#: Models and merges by rank can't be put into SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the classifier's cut go. It learns from the labels
    of documents whose crc32(doc_id as text) mod 4 is not 2."""
    labels = table(spark, sf_dir, "labels").where(id_bucket(F.col("doc_id"), 4) != 2)
    model = quality.train(docs, labels)
    return docs.where(quality.score(docs["text"], model) >= quality.CUT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has too are taken out of the texts;
    n_chars follows. A document stays even if nothing is left of it."""
    out = line_dedup(docs, out="__lines")
    lost = F.col("__lines.n_dropped") > 0
    changed = {"text": F.when(lost, F.col("__lines.kept_text")).otherwise(docs["text"])}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(lost, F.char_length("__lines.kept_text")).otherwise(docs["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return out.select(*[changed.get(c, docs[c]).alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows linked by five-word shingles the one with the smallest id stays,
    of several with that id the one with the least text. Rows are judged by their
    own texts: unrelated texts under one id all stay, rows that repeat id and text
    are one. Rows without an id stay."""
    # Numbered in writing, so every reader sees the same numbers.
    rows = keep(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    known = rows.where("doc_id is not null")
    found = near_dedup(known.select(F.col("__row").alias("doc_id"), "text"), width=5) \
        .select(F.col("doc_id").alias("__node"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("__component"))
    # A text without a word is linked with nothing, and is one only with its own repeats.
    ids = known.select("__row", F.col("doc_id").alias("__id"), F.md5("text").alias("__content"))
    ids = keep(ids.join(found, ids["__row"] == found["__node"]).select(
        "__row", "__id", "__component", F.when(F.col("__component").isNull(), F.col("__id")).alias("__alone"),
        F.when(F.col("__component").isNull(), F.col("__content")).alias("__content")), "rows-with-components")
    least = ids.groupBy("__component", "__alone", "__content").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    least = least.select(*[F.col(c).alias(f"{c}_") for c in ("__component", "__alone", "__content", "__first")])
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in ("__component", "__alone", "__content")]
    firsts = keep(ids.join(least, [*same, F.col("__id") == F.col("__first_")]).select("__row", "__component", "__alone", "__content"), "first-rows")
    # Only rows that share the smallest id are compared by their texts.
    keys = ["__component", "__alone", "__content"]
    single = firsts.groupBy(*keys).agg(F.min("__row").alias("__kept"), F.count("*").alias("__n"))
    several = single.where("__n > 1").select(*[F.col(c).alias(f"{c}_") for c in keys])
    tied = firsts.join(several, same).select("__row", *keys)
    texts = known.select(F.col("__row").alias("__node"), F.col("text").alias("__text"))
    chosen = tied.join(texts, F.col("__row") == F.col("__node")).groupBy(*keys).agg(F.min(F.struct("__text", "__row"))["__row"].alias("__kept"))
    kept = single.where("__n = 1").select("__kept").unionAll(chosen.select("__kept"))
    one = known.join(kept, F.col("__row") == F.col("__kept"), "left_semi")
    return one.unionByName(rows.where("doc_id is null")).drop("__row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a test item is found go."""
    found = leaked_items(docs["text"], table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(found) == 0)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and the sha256 of the ids (little-endian uint32) and of the bytes they decode to."""
    coded = docs.select("doc_id", byte_bpe(docs["text"], public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).alias("r"))
    return coded.select("doc_id", (F.octet_length("r.ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("r.ids", 256).alias("ids_sha256"), F.sha2("r.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", reject_low_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE encoding and decoding", encode_and_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
