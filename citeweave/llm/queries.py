"""The registered queries of the document operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import language, licenses, quality
from citeweave.llm.alignment import align
from citeweave.llm.byte_bpe import byte_bpe
from citeweave.llm.common import id_bucket, table
from citeweave.llm.cover_tree import embedding_links
from citeweave.llm.decontaminate import find_leaks
from citeweave.llm.exact_dedup import exact_dedup
from citeweave.llm.line_dedup import line_dedup
from citeweave.llm.near_dedup import near_dedup
from citeweave.llm.periodic_runs import collapse_runs
from citeweave.llm.rans import coded_ids
from citeweave.llm.suffix_dedup import suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _held_out(n: int, k: int):
    return F.coalesce(id_bucket(F.col("doc_id"), n) == k, F.lit(False))


@query
def op1_bradley_terry(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out(4, 2)
    model = quality.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.score(docs["text"], model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= quality.CUT, 1).otherwise(0))


@query
def op2_rans_ids(spark, sf_dir):
    ids = coded_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"), licenses.known_licences(spark))


SQL["op3_license_scan"] = licenses.oracle_sql()


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out(3, 1)
    model = language.train(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language.predict(docs["text"], model).alias("r"))
    return found.select("doc_id", "held_out", F.col("r.lang").alias("lang_pred"), "r.score", "r.accepted")


@query
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_points")


SQL["op5_exact_dedup"] = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = first_value(doc_id) over w as kept,
       text_sha256
from d window w as (partition by text_sha256 order by n_points desc, doc_id)
"""


@query
def op6_minhash(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"), width=2, similarity=80)


SQL["op6_minhash"] = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
g as (select distinct doc_id, unnest(case when len(words) = 0 then cast([] as varchar[]) when len(words) = 1 then words
        else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as shingle from w),
n as (select doc_id, count(*) as size from g group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from g a join g b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * shared >= 80 * (a.size + b.size - shared)),
e as (select x, y from l union all select y, x from l),
reach(doc_id, reached) as (select doc_id, doc_id from documents union select reach.doc_id, e.y from reach join e on e.x = reach.reached),
c as (select doc_id, min(reached) as component_id from reach group by doc_id)
select c.doc_id, coalesce(size, 0) as n_shingles, component_id, c.doc_id = component_id as kept from c left join n on n.doc_id = c.doc_id
"""


@query
def op7_bm25_leaks(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, out="r").select("doc_id", "r.n_lines", "r.n_dropped", F.sha2(F.col("r.kept_text"), 256).alias("kept_sha256"))


SQL["op8_line_dedup"] = r"""
with s as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
l as (select doc_id, unnest(parts) as line, unnest(range(len(parts))) as pos from s),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
dup as (select key, min(doc_id) as first_id from k where length(key) >= 10
        group by key having count(distinct doc_id) >= 2),
m as (select k.*, dup.key is not null and k.doc_id <> first_id as gone from k left join dup using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""


@query
def op9_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", byte_bpe(docs["text"], public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).alias("r"))
    return coded.select("doc_id", (F.octet_length("r.ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("r.ids", 256).alias("ids_sha256"), F.sha2("r.decoded", 256).alias("decoded_sha256"))


@query
def op10_suffix_array(spark, sf_dir):
    cut = suffix_dedup(table(spark, sf_dir, "documents"), out="r")
    return cut.select("doc_id", "r.n_bytes", "r.n_removed", "r.n_spans", F.sha2("r.kept", 256).alias("kept_sha256"))


@query
def op11_cover_tree(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.98)


SQL["op11_cover_tree"] = r"""
with recursive v as (
  select distinct vec_id, label, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
      where list_cosine_similarity(a.e, b.e) >= 0.98),
n as (select x, count(*) as n_links from l group by x),
reach(vec_id, reached) as (select vec_id, vec_id from embeddings union select reach.vec_id, l.y from reach join l on l.x = reach.reached),
c as (select vec_id, min(reached) as component_id from reach group by vec_id)
select v.vec_id, coalesce(n_links, 0) as n_links, component_id, v.vec_id = component_id as kept
from embeddings v join c on c.vec_id = v.vec_id left join n on n.x = v.vec_id
"""


@query
def op12_alignment(spark, sf_dir):
    found, _ = align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found


def _made_periodic(doc_id, text):
    """The texts of op13: with h = crc32(decimal doc_id) divisible by ten, g = floor(h / 10)
    and n > 0 words, each word i >= a = g % n becomes word a + (i - a) % p with
    p = 1 + floor((n - a) / (3 + g % 8)); every other text as it is."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")

    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    # A lambda's argument is evaluated once, however often it is named.
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text))
    return F.when(h % 10 == 0, F.get(made, F.lit(0))).otherwise(text)


@query
def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", collapse_runs(_made_periodic(F.col("doc_id"), F.col("text"))).alias("r"))
    runs = F.col("r.runs")
    # The greatest length, then the smallest start and period.
    best = F.array_min(F.transform(runs, lambda x: F.struct(-x["length"], x["start"], x["period"]).alias("b")))
    listed = F.array_join(F.transform(runs, lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    length = -best["col1"]
    return found.select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"), best["start"].alias("start"), length.alias("length"), best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        F.sha2(F.when(F.size(runs) > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("r.collapsed", 256).alias("collapsed_sha256"))
