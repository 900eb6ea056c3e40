"""The graph object shared by all operators, and the two graph builders.

Publication and journal graphs differ only in how vertices and edges are
derived; degrees, PageRank, summaries and neighbourhood queries are written
once against ``CitationGraph``.

Building a graph runs PageRank (a loop of jobs), so built graphs are kept
per (session, corpus, kind) and reused by every query on the same corpus.
Kept frames are Parquet tables in the shared checkpoint folder, not cached
blocks: losing an executor loses nothing, and a question reads only the
columns it needs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import count
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.operators import degrees, edges as E
from citeweave.operators.adjacency import BROADCAST_SEEDS, Adjacency, Seeds, adjacency, neighbor_ids, ranked
from citeweave.operators.indexing import dense_index
from citeweave.operators.neighbors import with_position
from citeweave.operators.pagerank import DEFAULT_RESET, DEFAULT_TOL, pagerank
from citeweave.session import drop_kept, keep


@dataclass
class CitationGraph:
    kind: str  # "publication" | "journal"
    vertices: DataFrame  # (id, name, in_deg, out_deg, pr, position, node); position: place by rank, node: place by id, both from 0
    edges: DataFrame  # (src, dst, n, src_node, dst_node); publication edges have n = 1 per parallel edge
    rounds: int = 0
    info: dict = field(default_factory=dict)
    lookups: Adjacency | None = None  # ``adjacent``, once it is written
    same_name: int | None = None  # most vertices that share a name

    # -- questions a user asks of a graph ------------------------------------

    def top(self, k: int) -> DataFrame:
        """The k highest-ranked vertices, with their 1-based position."""
        from citeweave.operators.neighbors import top_k

        return top_k(self.vertices, k)

    def influential(self, names, direction: str = "in", names_bound: int | None = None) -> DataFrame:
        """Neighbours of the vertices carrying ``names`` (a string, a list of
        strings or a DataFrame with a ``name`` column, of ``names_bound`` rows at
        most), ranked by PageRank. ``in``: vertices citing them, ``out``: vertices
        they cite, ``either``: both."""
        from citeweave.operators.neighbors import vertices_by_name

        spark = self.vertices.sparkSession
        if isinstance(names, str):
            names = [names]
        if isinstance(names, (list, tuple)):
            names_bound = len(names)
            names = spark.createDataFrame([(n,) for n in names], "name string")
        found = vertices_by_name(self.vertices, names, names_bound).select("seed_name", "seed_id", F.col("position").alias("seed_position"))
        bound = None if names_bound is None or self.same_name is None else names_bound * self.same_name
        return ranked(self.vertices, self.adjacent, Seeds(found, bound), direction, "seed_name")

    def neighbors(self, seeds: DataFrame, direction: str = "in", seeds_bound: int | None = None) -> DataFrame:
        """(seed_id, neighbor_id, via) for a DataFrame of ``seed_id``."""
        rows = F.broadcast(seeds.select("seed_id")) if seeds_bound is not None and seeds_bound <= BROADCAST_SEEDS else seeds.select("seed_id")
        found = self.vertices.select("id", F.col("position").alias("seed_position")).join(rows, F.col("id") == F.col("seed_id"))
        return neighbor_ids(self.vertices, self.adjacent, Seeds(found.select("seed_id", "seed_position"), seeds_bound), direction)

    def top_neighbors(self, k: int, direction: str = "in") -> DataFrame:
        """(seed_id, neighbor_id, via) for the k highest-ranked vertices."""
        return neighbor_ids(self.vertices, self.adjacent, self._top_seeds(k), direction)

    def influence_report(self, k: int, direction: str = "in") -> DataFrame:
        """Ranked neighbours of each of the k highest-ranked vertices, in one job:
        (seed_position, seed_id, seed_name, rank, neighbor_id, name, in_deg, out_deg, pr, via)."""
        seeds = self._top_seeds(k, F.col("name").alias("seed_name"))
        found = ranked(self.vertices, self.adjacent, seeds, direction, "seed_position", "seed_name")
        return found.select((F.col("seed_position") + 1).alias("seed_position"), "seed_id", "seed_name", "rank",
                            "neighbor_id", "name", "in_deg", "out_deg", "pr", "via")

    def _top_seeds(self, k: int, *also) -> Seeds:
        rows = self.vertices.where(F.col("position") < k).select(F.col("id").alias("seed_id"), F.col("position").alias("seed_position"), *also)
        return Seeds(rows, bound=k, prefix=k)

    @property
    def adjacent(self) -> Adjacency:
        """The edges by position, for lookups; written when they are first asked for."""
        if self.lookups is None:
            self.lookups = adjacency(self.edges, self.vertices.select("node", "position"), self.kind)
        return self.lookups

    def summary(self) -> DataFrame:
        from citeweave.operators.summary import graph_summary

        return graph_summary(self.vertices)

    def rank_values(self) -> DataFrame:
        from citeweave.operators.summary import rank_values

        return rank_values(self.vertices)

    def max_degree(self) -> DataFrame:
        from citeweave.operators.summary import max_degree_vertices

        return max_degree_vertices(self.vertices)

    def in_degrees(self) -> DataFrame:
        return degrees.in_degrees(self.edges)

    def out_degrees(self) -> DataFrame:
        return degrees.out_degrees(self.edges)

    def with_default(self, default: str = "nocitation") -> DataFrame:
        return degrees.with_default_vertices(self.vertices, self.edges, default)

    def node_link(self) -> tuple[DataFrame, DataFrame]:
        """(nodes(idx, id, name), links(source, target)): vertices numbered
        0.. in id order and edges as pairs of node numbers, as they are stored."""
        return self.vertices.select(F.col("node").alias("idx"), "id", "name"), \
            self.edges.select(F.col("src_node").alias("source"), F.col("dst_node").alias("target"))

    def write_node_link(self, path: str) -> str:
        """Distributed JSON write of ``node_link`` to path/nodes and path/links."""
        nodes, links = self.node_link()
        nodes.write.mode("overwrite").json(f"{path.rstrip('/')}/nodes")
        links.write.mode("overwrite").json(f"{path.rstrip('/')}/links")
        return path

    def write(self, path: str) -> str:
        """Save the graph as parquet (path/vertices, path/edges, path/incoming,
        path/outgoing, path/_meta) so later applications query it without rebuilding."""
        spark = self.vertices.sparkSession
        base, near = path.rstrip("/"), self.adjacent
        for name, table in (("vertices", self.vertices), ("edges", self.edges), ("incoming", near.incoming), ("outgoing", near.outgoing)):
            table.write.mode("overwrite").parquet(f"{base}/{name}")
        meta = spark.createDataFrame([(self.kind, self.rounds, self.same_name)], "kind string, rounds int, same_name bigint")
        meta.coalesce(1).write.mode("overwrite").json(f"{base}/_meta")
        return path

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "CitationGraph":
        """A graph saved with ``write``."""
        base = path.rstrip("/")
        meta = spark.read.schema("kind string, rounds int, same_name bigint").json(f"{base}/_meta").first()
        table = {name: spark.read.parquet(f"{base}/{name}") for name in ("vertices", "edges", "incoming", "outgoing")}
        return cls(kind=meta["kind"], vertices=table["vertices"], edges=table["edges"], rounds=meta["rounds"],
                   lookups=Adjacency(table["incoming"], table["outgoing"]), same_name=meta["same_name"])

    def unpersist(self) -> None:
        """Delete the files of a built graph; it can't be asked any more."""
        drop_kept(self.vertices, self.edges, *([self.lookups.incoming, self.lookups.outgoing] if self.lookups else []))


def _finish(kind: str, vertices: DataFrame, edges: DataFrame, result) -> CitationGraph:
    """vertices (node, id, name), edges (src, dst, n, src_node, dst_node), result: ranks and
    degrees by node. Joins are on node numbers; the edges are not read."""
    ranked_rows = degrees.attach_ranks(vertices.select(F.col("node").alias("id"), "name", F.col("id").alias("key")), result.ranks)
    attributed = keep(ranked_rows.select(F.col("key").alias("id"), "name", "in_deg", "out_deg", "pr", F.col("id").alias("node")), f"{kind}-attributes")
    placed = with_position(attributed)
    kept = keep(placed.select("id", "name", "in_deg", "out_deg", "pr", "position", "node"), f"{kind}-vertices")
    drop_kept(attributed, placed)
    # Journals are their names; titles repeat.
    same_name = 1 if kind == "journal" else kept.groupBy("name").count().agg(F.max("count")).first()[0]
    return CitationGraph(kind=kind, vertices=kept, edges=edges, rounds=result.rounds,
                         info={"vertices": result.vertices, "partitions": result.partitions, "salted": result.salted},
                         same_name=same_name or 1)


def build_publication_graph(pubs: DataFrame, tol: float = DEFAULT_TOL, reset: float = DEFAULT_RESET,
                            edges_per_bucket: int = 1_000_000) -> CitationGraph:
    """Vertices get their place in id order as a bigint surrogate once; citations
    resolve straight to it, so PageRank and lookups run on fixed-width keys."""
    vertices = dense_index(E.publication_vertices(pubs), ["id"], name="node")
    edges = E.publication_edges_keyed(pubs, vertices).withColumn("n", F.lit(1).cast("bigint"))
    return _ranked("publication", vertices, edges, tol, reset, edges_per_bucket)


def build_journal_graph(pubs: DataFrame, tol: float = DEFAULT_TOL, reset: float = DEFAULT_RESET,
                        edges_per_bucket: int = 1_000_000) -> CitationGraph:
    """Rank and degrees count each journal pair once; n does not weight them."""
    vertices = dense_index(E.journal_vertices(pubs), ["id"], name="node")
    src = vertices.select(F.col("id").alias("src"), F.col("node").alias("src_node"))
    dst = vertices.select(F.col("id").alias("dst"), F.col("node").alias("dst_node"))
    return _ranked("journal", vertices, E.journal_edges(pubs).join(src, "src").join(dst, "dst"), tol, reset, edges_per_bucket)


def _ranked(kind: str, vertices: DataFrame, edges: DataFrame, tol: float, reset: float, edges_per_bucket: int) -> CitationGraph:
    edges = keep(edges.select("src", "dst", "n", "src_node", "dst_node"), f"{kind}-edges")
    result = pagerank(vertices.select(F.col("node").alias("id")), edges.select(F.col("src_node").alias("src"), F.col("dst_node").alias("dst")),
                      tol=tol, reset=reset, edges_per_bucket=edges_per_bucket, dense_ids=False)
    graph = _finish(kind, vertices, edges, result)
    drop_kept(vertices)
    return graph


def build_graphs(pubs: DataFrame, tol: float = DEFAULT_TOL, reset: float = DEFAULT_RESET,
                 edges_per_bucket: int = 1_000_000) -> tuple[CitationGraph, CitationGraph]:
    """Both graphs of a corpus, built concurrently: jobs submitted from two
    threads run side by side in the same application (each PageRank loop has
    its own session, so they do not interfere). Returns (publications,
    journals)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=2, thread_name_prefix="citeweave-graph") as pool:
        pub = pool.submit(build_publication_graph, pubs, tol, reset, edges_per_bucket)
        jour = pool.submit(build_journal_graph, pubs, tol, reset, edges_per_bucket)
        return pub.result(), jour.result()


def load_corpus(spark: SparkSession, path: str, mode: str = "FAILFAST", sample: float | None = None,
                sample_seed: int = 2, by_hash: bool = True, partitions: int | None = None) -> DataFrame:
    """Publication records from JSON lines, ready for the graph builders.

    ``sample`` keeps a fraction of records: by key hash (the same records on
    every run and layout) or, with ``by_hash=False``, Bernoulli with the
    seed. ``partitions`` repartitions the records (the reference run used a
    fixed count; by default the scan's own splits and AQE decide). The
    result is written once: every later job reads the parsed records.
    """
    from citeweave.sources import jsonl, sampling

    pubs = jsonl.read_publications(spark, path, mode=mode)
    if sample is not None:
        pubs = sampling.sample_by_hash(pubs, sample, "id", sample_seed) if by_hash \
            else sampling.sample_bernoulli(pubs, sample, sample_seed)
    if partitions:
        pubs = pubs.repartition(partitions)
    return keep(pubs, "records")


_BUILT: dict = {}
_SESSIONS = WeakKeyDictionary()  # a number for each live session; numbers are not used again
_NUMBERS = count()


def _session_number(spark: SparkSession) -> int:
    if spark not in _SESSIONS:
        _SESSIONS[spark] = next(_NUMBERS)
    return _SESSIONS[spark]


def _key(spark: SparkSession, corpus_key: str, kind: str):
    # Kept frames belong to the application and session that built them.
    return (spark.sparkContext.applicationId, _session_number(spark), corpus_key, kind)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived corpus of a test-table folder, materialised once."""
    from citeweave.sources.corpus import derived_corpus

    k = _key(spark, sf_dir, "corpus")
    if k not in _BUILT:
        _BUILT[k] = keep(derived_corpus(spark, sf_dir), "corpus")
    return _BUILT[k]


def publication_graph(spark: SparkSession, sf_dir: str) -> CitationGraph:
    k = _key(spark, sf_dir, "publication")
    if k not in _BUILT:
        _BUILT[k] = build_publication_graph(corpus(spark, sf_dir))
    return _BUILT[k]


def journal_graph(spark: SparkSession, sf_dir: str) -> CitationGraph:
    k = _key(spark, sf_dir, "journal")
    if k not in _BUILT:
        _BUILT[k] = build_journal_graph(corpus(spark, sf_dir))
    return _BUILT[k]


def graphs(spark: SparkSession, sf_dir: str) -> tuple[CitationGraph, CitationGraph]:
    """Both kept graphs of a test-table folder, built concurrently if needed."""
    kp, kj = _key(spark, sf_dir, "publication"), _key(spark, sf_dir, "journal")
    if kp not in _BUILT and kj not in _BUILT:
        _BUILT[kp], _BUILT[kj] = build_graphs(corpus(spark, sf_dir))
    return publication_graph(spark, sf_dir), journal_graph(spark, sf_dir)


def forget(spark: SparkSession | None = None) -> None:
    """Drop kept graphs and tables (all, or those of one session) and their
    files. Call it when tables that were read have changed."""
    for k in list(_BUILT):
        if spark is None or k[:2] == (spark.sparkContext.applicationId, _session_number(spark)):
            kept = _BUILT.pop(k)
            if isinstance(kept, CitationGraph):
                kept.unpersist()
            elif isinstance(kept, DataFrame):
                drop_kept(kept)
