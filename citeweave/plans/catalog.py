"""Named queries over a test-table folder, one per operator.

Each entry takes (spark, sf_dir) and returns a DataFrame whose column names
and types match the SQL in ``citeweave.plans.oracle``. Arrays are rendered
as space-joined strings and ranks rounded to 6 decimals so that two engines
can be compared value by value.

Graph-level keys share one built graph per (session, folder): the corpus,
both graphs and their ranks are computed once and kept as written tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions.hexdec import hex_to_decimal, hex_to_decimal_string
from citeweave.operators import degrees, edges as E, summary as S
from citeweave.operators.indexing import dense_index
from citeweave.operators.neighbors import top_k, vertices_by_name
from citeweave.plans.graph import _BUILT, _key, corpus, journal_graph, publication_graph
from citeweave.session import scratch_path
from citeweave.sources import jsonl, sampling
from citeweave.sources.corpus import as_records

# Seeds per entity and sample parameters of the reference's test mode.
TOP_K = 5
SAMPLE_FRACTION = 0.33
SAMPLE_SEED = 2
# Rules that corrupt lines of the JSON round trip for the quarantine check.
TRUNCATE_EVERY = 13
EMPTY_EVERY = 17

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def wrap(fn):
        QUERIES[name] = fn
        return fn
    return wrap


def _list_text(col: str):
    return F.array_join(F.coalesce(F.col(col), F.array().cast("array<string>")), " ")


def _corpus_json(spark: SparkSession, sf_dir: str) -> str:
    """The corpus written once as JSON-lines records; returns the folder."""
    k = _key(spark, sf_dir, "corpus-json")
    if k not in _BUILT:
        _BUILT[k] = jsonl.write_json_lines(as_records(corpus(spark, sf_dir)), scratch_path(spark, "corpus-json"))
    return _BUILT[k]


def _damaged_json(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as JSON lines with rule-based damage: truncated lines and
    empty objects, written once, a gzip file for each task."""
    k = _key(spark, sf_dir, "damaged-json")
    if k not in _BUILT:
        recs = as_records(corpus(spark, sf_dir))
        key = F.conv(F.substring(F.md5("id"), 1, 4), 16, 10).cast("bigint")
        line = F.to_json(F.struct(*recs.columns))
        text = (
            F.when(key % TRUNCATE_EVERY == 0, F.expr("substring(value, 1, length(value) - 2)"))
            .when(key % EMPTY_EVERY == 0, F.lit("{}"))
            .otherwise(F.col("value"))
        )
        out = scratch_path(spark, "damaged-json")
        recs.select(line.alias("value"), "id").select(text.alias("value")).write.mode("overwrite").option("compression", "gzip").text(out)
        _BUILT[k] = out
    return _BUILT[k]


# -- scans and sampling ------------------------------------------------------

@query("scan_publications")
def q_scan_publications(spark, sf_dir):
    pubs = jsonl.read_publications(spark, _corpus_json(spark, sf_dir), mode="FAILFAST")
    return pubs.select("id", "title", "journalName",
                       F.size("outCitations").cast("bigint").alias("n_cited"), _list_text("outCitations").alias("cited"))


@query("scan_quarantine")
def q_scan_quarantine(spark, sf_dir):
    _, bad = jsonl.scan_with_quarantine(spark, _damaged_json(spark, sf_dir))
    return bad.select("reason", "recovered_id")


@query("sample_bernoulli")
def q_sample_bernoulli(spark, sf_dir):
    return sampling.sample_bernoulli(corpus(spark, sf_dir), SAMPLE_FRACTION, SAMPLE_SEED).select("id", "title")


@query("sample_by_hash")
def q_sample_by_hash(spark, sf_dir):
    return sampling.sample_by_hash(corpus(spark, sf_dir), SAMPLE_FRACTION, "id", SAMPLE_SEED).select("id", "title")


@query("corpus_count")
def q_corpus_count(spark, sf_dir):
    return corpus(spark, sf_dir).agg(F.count("*").alias("n_records"))


@query("stream_ingest_publications")
def q_stream_ingest_publications(spark, sf_dir):
    """The damaged JSON lines ingested by the streaming query (one run over
    what has landed); the good records it wrote."""
    from citeweave.streaming.ingest import start_ingest

    k = _key(spark, sf_dir, "stream-table")
    if k not in _BUILT:
        base = scratch_path(spark, "stream")
        q = start_ingest(spark, _damaged_json(spark, sf_dir), f"{base}/table", f"{base}/quarantine",
                         f"{base}/state")
        q.awaitTermination()  # it stops by itself when all that has landed is read
        _BUILT[k] = f"{base}/table"
    table = spark.read.parquet(_BUILT[k])
    return table.select("id", "title", "journalName",
                        F.size("outCitations").cast("bigint").alias("n_cited"), _list_text("outCitations").alias("cited"))


# -- projections, filters, flattening ------------------------------------------

@query("publication_vertices")
def q_publication_vertices(spark, sf_dir):
    return E.publication_vertices(corpus(spark, sf_dir))


@query("distinct_citation_lists")
def q_distinct_citation_lists(spark, sf_dir):
    return E.distinct_citation_lists(corpus(spark, sf_dir)).select(
        "id", F.size("outCitations").cast("bigint").alias("n_cited"), _list_text("outCitations").alias("cited"))


@query("citing_publications")
def q_citing_publications(spark, sf_dir):
    return E.citing_publications(corpus(spark, sf_dir)).select(
        "id", F.size("outCitations").cast("bigint").alias("n_cited"))


@query("citations_exploded")
def q_citations_exploded(spark, sf_dir):
    return E.citations_exploded(corpus(spark, sf_dir)).select("src", F.col("pos").cast("bigint").alias("pos"), "cited")


@query("vertex_by_name")
def q_vertex_by_name(spark, sf_dir):
    g = publication_graph(spark, sf_dir)
    names = top_k(g.vertices, TOP_K).select("name")
    return vertices_by_name(g.vertices, names, names_bound=TOP_K).select(
        "seed_name", "seed_id", "in_deg", "out_deg", S.rounded_pr().alias("pr"))


# -- joins and key resolution ------------------------------------------------

@query("dense_publication_index")
def q_dense_publication_index(spark, sf_dir):
    v = E.publication_vertices(corpus(spark, sf_dir)).select("id")
    return dense_index(v, ["id"], name="idx")


@query("dense_journal_index")
def q_dense_journal_index(spark, sf_dir):
    v = E.journal_vertices(corpus(spark, sf_dir)).select("id")
    return dense_index(v, ["id"], name="idx")


@query("publication_edges")
def q_publication_edges(spark, sf_dir):
    return E.publication_edges(corpus(spark, sf_dir))


@query("unresolved_citations")
def q_unresolved_citations(spark, sf_dir):
    return E.unresolved_citations(corpus(spark, sf_dir)).select("src", F.col("pos").cast("bigint").alias("pos"), "cited")


@query("publication_journal")
def q_publication_journal(spark, sf_dir):
    return E.publication_journal(corpus(spark, sf_dir))


@query("journals")
def q_journals(spark, sf_dir):
    return E.journals(corpus(spark, sf_dir))


@query("publication_graph")
def q_publication_graph(spark, sf_dir):
    g = publication_graph(spark, sf_dir)
    return g.vertices.select("id", "name", "in_deg", "out_deg", S.rounded_pr().alias("pr"))


@query("journal_graph")
def q_journal_graph(spark, sf_dir):
    g = journal_graph(spark, sf_dir)
    return g.vertices.select("id", "name", "in_deg", "out_deg", S.rounded_pr().alias("pr"))


@query("graph_with_default")
def q_graph_with_default(spark, sf_dir):
    g = publication_graph(spark, sf_dir)
    return degrees.with_default_vertices(g.vertices, g.edges)


# -- aggregations ------------------------------------------------------------

@query("journal_edges")
def q_journal_edges(spark, sf_dir):
    return E.journal_edges(corpus(spark, sf_dir))


@query("in_degrees")
def q_in_degrees(spark, sf_dir):
    return degrees.in_degrees(publication_graph(spark, sf_dir).edges)


@query("out_degrees")
def q_out_degrees(spark, sf_dir):
    return degrees.out_degrees(publication_graph(spark, sf_dir).edges)


@query("journal_in_degrees")
def q_journal_in_degrees(spark, sf_dir):
    return degrees.in_degrees(journal_graph(spark, sf_dir).edges)


@query("journal_out_degrees")
def q_journal_out_degrees(spark, sf_dir):
    return degrees.out_degrees(journal_graph(spark, sf_dir).edges)


@query("publication_summary")
def q_publication_summary(spark, sf_dir):
    return S.graph_summary(publication_graph(spark, sf_dir).vertices)


@query("journal_summary")
def q_journal_summary(spark, sf_dir):
    return S.graph_summary(journal_graph(spark, sf_dir).vertices)


@query("journal_rank_values")
def q_journal_rank_values(spark, sf_dir):
    return S.rank_values(journal_graph(spark, sf_dir).vertices)


@query("max_degree_vertices")
def q_max_degree_vertices(spark, sf_dir):
    return S.max_degree_vertices(publication_graph(spark, sf_dir).vertices)


@query("journal_max_degree_vertices")
def q_journal_max_degree_vertices(spark, sf_dir):
    return S.max_degree_vertices(journal_graph(spark, sf_dir).vertices)


# -- PageRank, neighbourhoods, top-k -------------------------------------------

@query("publication_pagerank")
def q_publication_pagerank(spark, sf_dir):
    return publication_graph(spark, sf_dir).vertices.select("id", S.rounded_pr().alias("pr"))


@query("journal_pagerank")
def q_journal_pagerank(spark, sf_dir):
    return journal_graph(spark, sf_dir).vertices.select("id", S.rounded_pr().alias("pr"))


@query("neighbors_in")
def q_neighbors_in(spark, sf_dir):
    return publication_graph(spark, sf_dir).top_neighbors(TOP_K, "in")


@query("neighbors_out")
def q_neighbors_out(spark, sf_dir):
    return publication_graph(spark, sf_dir).top_neighbors(TOP_K, "out")


@query("neighbors_either")
def q_neighbors_either(spark, sf_dir):
    return publication_graph(spark, sf_dir).top_neighbors(TOP_K, "either")


@query("influential_publications")
def q_influential_publications(spark, sf_dir):
    g = publication_graph(spark, sf_dir)
    return g.influential(g.top(TOP_K).select("name"), "either", names_bound=TOP_K)


@query("influential_journals")
def q_influential_journals(spark, sf_dir):
    g = journal_graph(spark, sf_dir)
    return g.influential(g.top(TOP_K).select("name"), "either", names_bound=TOP_K)


@query("top_publications")
def q_top_publications(spark, sf_dir):
    return top_k(publication_graph(spark, sf_dir).vertices, TOP_K)


@query("top_journals")
def q_top_journals(spark, sf_dir):
    return top_k(journal_graph(spark, sf_dir).vertices, TOP_K)


@query("influence_report_publications")
def q_influence_report_publications(spark, sf_dir):
    return publication_graph(spark, sf_dir).influence_report(TOP_K, "in")


@query("influence_report_journals")
def q_influence_report_journals(spark, sf_dir):
    return journal_graph(spark, sf_dir).influence_report(TOP_K, "in")


@query("influence_report_csv")
def q_influence_report_csv(spark, sf_dir):
    """The publications' report written as CSV and read back by its schema."""
    k = _key(spark, sf_dir, "report-csv")
    report = publication_graph(spark, sf_dir).influence_report(TOP_K, "in")
    if k not in _BUILT:
        _BUILT[k] = jsonl.write_csv(report, scratch_path(spark, "report-csv"))
    return jsonl.read_csv(spark, _BUILT[k], report.schema)


@query("graph_links")
def q_graph_links(spark, sf_dir):
    _, links = publication_graph(spark, sf_dir).node_link()
    return links


# -- scalar functions ----------------------------------------------------------

@query("hex_to_decimal")
def q_hex_to_decimal(spark, sf_dir):
    pubs = corpus(spark, sf_dir)
    key = F.md5(F.col("id"))
    return pubs.select(
        "id",
        hex_to_decimal("id").alias("id_dec"),
        hex_to_decimal_string(key).alias("key_dec"),
        hex_to_decimal(key).alias("key_fold"),
    )
