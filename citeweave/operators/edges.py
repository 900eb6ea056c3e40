"""Vertices and edges of the publication and journal graphs.

Publication graph
  * every record is a vertex, keyed by its natural id; a repeated id keeps
    the smallest title;
  * identical (id, outCitations) records collapse before expansion;
  * each element of a reference list is one edge citing -> cited; repeated
    elements are parallel edges and self-citations stay;
  * citations of ids outside the corpus are dropped (and can be listed).

Journal graph
  * vertices are the distinct non-empty journal names (null counts as empty);
  * a record's citations are mapped to the cited record's journal; self-edges
    and citations to records without a journal are dropped;
  * edges are unique (src, dst) pairs with n = number of citations. Records
    are not de-duplicated on this path, so a repeated record counts again.

All resolution steps are equi-joins; with AQE on, Spark picks a broadcast or
a shuffle join from the runtime sizes and splits skewed join keys. A paper
cited by a large share of the corpus is such a key. AQE can only split a
join whose inputs are both plain shuffles, so the key tables probed by the
citations (vertex ids, publication -> journal) are materialised first
rather than fed to the join straight out of their own aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def has_journal(col: str = "journalName"):
    return F.coalesce(F.col(col), F.lit("")) != ""


def _key_table(df: DataFrame) -> DataFrame:
    """Write a per-key table before it is probed by citation rows, so the join
    gets its own, splittable exchange."""
    from citeweave.session import keep

    return keep(df, "keys")


def publication_vertices(pubs: DataFrame) -> DataFrame:
    """(id, name): one vertex per distinct id."""
    return pubs.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("title").alias("name"))


def distinct_citation_lists(pubs: DataFrame) -> DataFrame:
    """(id, outCitations) with identical records collapsed; a record without an
    id is no publication."""
    return pubs.where(F.col("id").isNotNull()).select("id", F.coalesce("outCitations", F.array().cast("array<string>")).alias("outCitations")).distinct()


def citing_publications(pubs: DataFrame) -> DataFrame:
    """Distinct citation lists that are non-empty."""
    return distinct_citation_lists(pubs).where(F.size("outCitations") > 0)


def citations_exploded(pubs: DataFrame) -> DataFrame:
    """(src, pos, cited): one row per element of each distinct reference list."""
    return distinct_citation_lists(pubs).select(
        F.col("id").alias("src"), F.posexplode("outCitations").alias("pos", "cited")
    )


def publication_edges(pubs: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(src, dst): resolved citations, parallel edges and self-loops kept."""
    vertices = vertices if vertices is not None else _key_table(publication_vertices(pubs))
    ids = vertices.select(F.col("id").alias("dst"))
    return citations_exploded(pubs).join(ids, F.col("cited") == F.col("dst"), "inner").select("src", "dst")


def publication_edges_keyed(pubs: DataFrame, keyed_vertices: DataFrame) -> DataFrame:
    """(src, dst, src_node, dst_node): resolved citations carrying both the
    natural ids and the vertices' bigint surrogates (column ``node`` of
    ``keyed_vertices``). The source surrogate is attached per reference
    list, before the expansion, so the only join over the expanded rows is
    the resolution join itself."""
    src_keys = keyed_vertices.select("id", F.col("node").alias("src_node"))
    dst_keys = keyed_vertices.select(F.col("id").alias("dst"), F.col("node").alias("dst_node"))
    lists = distinct_citation_lists(pubs).join(src_keys, "id")
    return (
        lists.select(F.col("id").alias("src"), "src_node", F.explode("outCitations").alias("cited"))
        .join(dst_keys, F.col("cited") == F.col("dst"), "inner")
        .select("src", "dst", "src_node", "dst_node")
    )


def unresolved_citations(pubs: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(src, pos, cited) whose cited id is not in the corpus."""
    vertices = vertices if vertices is not None else _key_table(publication_vertices(pubs))
    ids = vertices.select(F.col("id").alias("cited"))
    return citations_exploded(pubs).join(ids, "cited", "left_anti").select("src", "pos", "cited")


def publication_journal(pubs: DataFrame) -> DataFrame:
    """(id, journalName) for records with a journal; one journal per id
    (the smallest name if an id is filed under several). A record without an
    id is no publication, so nothing can cite it."""
    return pubs.where(F.col("id").isNotNull() & has_journal()).groupBy("id").agg(F.min("journalName").alias("journalName"))


def journal_vertices(pubs: DataFrame) -> DataFrame:
    """(id, name): one vertex per distinct non-empty journal name."""
    return pubs.where(has_journal()).select(F.col("journalName").alias("id")).distinct().withColumn("name", F.col("id"))


def journals(pubs: DataFrame) -> DataFrame:
    """Per journal: number of records, distinct record ids, outgoing
    citations, and the smallest / largest record id. Aggregates only: a
    journal's records are never gathered into one row."""
    return (
        pubs.where(has_journal())
        .groupBy("journalName")
        .agg(
            F.count("*").alias("n_records"),
            F.count_distinct("id").alias("n_publications"),
            F.sum(F.size(F.coalesce("outCitations", F.array()))).cast("bigint").alias("n_citations"),
            F.min("id").alias("min_id"),
            F.max("id").alias("max_id"),
        )
    )


def journal_citations(pubs: DataFrame) -> DataFrame:
    """(src, dst): one row per citation between two different journals."""
    targets = _key_table(publication_journal(pubs)).select(F.col("id").alias("cited"),
                                                            F.col("journalName").alias("dst"))
    return (
        pubs.where(has_journal())
        .select(F.col("journalName").alias("src"), F.explode("outCitations").alias("cited"))
        .join(targets, "cited", "inner")
        .where(F.col("src") != F.col("dst"))
        .select("src", "dst")
    )


def journal_edges(pubs: DataFrame) -> DataFrame:
    """(src, dst, n): unique journal pairs with their citation count
    (partial aggregation on the map side, final after the shuffle)."""
    return journal_citations(pubs).groupBy("src", "dst").agg(F.count("*").alias("n"))


def dedupe_publications(pubs: DataFrame) -> DataFrame:
    """Collapse identical records; an explicit step before the journal path
    when repeated records should not inflate citation counts."""
    return pubs.dropDuplicates()
