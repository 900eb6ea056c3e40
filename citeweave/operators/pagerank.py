"""PageRank to a tolerance, as delta propagation over DataFrames.

Semantics (the dynamic, tolerance-driven form):

    k(v)        out-edges of v, parallel edges and self-loops included
    delta_0(v)  = reset                                  for every vertex
    delta_t(d)  = (1 - reset) * sum over edges s->d whose sender s received
                  a value in round t-1 with delta_{t-1}(s) > tol of
                  delta_{t-1}(s) / k(s)
    rank(v)     = sum over rounds of delta_t(v)     until no vertex sends
    pr(v)       = rank(v) * N / sum(rank)           (ranks sum to N)

The tolerance test is strict and applies to the sender. Sinks absorb mass
and only the final rescale corrects for it.

Execution plan
  * Non-integer vertex keys (paper ids are 40-character strings) are mapped
    to unique bigint surrogates first: the edge table every round scans
    shrinks to fixed-width rows, and joins hash a long instead of a string.
  * The edges are laid out once: parallel edges are folded into one weighted
    edge w = m / k(src) (map-side partial aggregation first, so copies of a
    pair collapse before they are shuffled), the folded pairs are
    hash-partitioned on the source into P partitions, and the layout is
    checkpointed, then kept on the executors for the rounds. Each round's
    deltas come out of the message aggregation hash-partitioned on the
    vertex into the same P partitions, so the next round joins them to the
    edges partition by partition with no exchange on either side; the edge
    table never moves.
    The one shuffle per round is the message sum, with map-side partial
    aggregation (a heavily cited vertex costs one row per map task).
  * Hot sources are split: a vertex with more than ``edges_per_bucket``
    out-edges spreads them over ceil(k / edges_per_bucket) buckets, the
    layout is partitioned on (source, bucket), and each hot sender's delta is
    replicated to its buckets (only this small side is shuffled). The hot
    list has at most edges / edges_per_bucket rows (the bucket size is raised
    if needed to keep that under MAX_HOT_SOURCES), so it is broadcast. No
    single task then holds a hub's edges.
  * The loop runs in its own session of the same application (``newSession``)
    with adaptive execution off and the shuffle partition count pinned to P:
    AQE would re-plan every round and a checkpoint taken under AQE does not
    report its partitioning, which would put an exchange of the whole edge
    table into every round. Skew in the loop is handled by the salting and
    partial aggregation above. The caller's session is never reconfigured;
    frames cross between the sessions as global temporary views.
  * The state is one row per vertex: its rank so far and its degrees,
    hash-partitioned on the vertex into the same P partitions. A round's deltas
    are checkpointed in the shared folder, which cuts the lineage and survives
    executor loss; every ``rounds_per_fold`` rounds they are joined to the state
    partition by partition, the new state is checkpointed, and the files of the
    deltas and of the state before it are deleted. So the folder holds two states
    and ``rounds_per_fold`` deltas at most, however many rounds there are, and the
    ranks need no shuffle at the end.
  * A round's job observes how many vertices it reached and how many of them may
    send, so the driver receives two numbers per round and nothing else.
  * In round one every vertex sends the same value, so its message sum needs no
    join, and the same pass over the layout counts every vertex's in-edges;
    out-edges are known from the layout. Degrees need no look at the edges later.

Endpoints of edges with bigint keys have to be vertices; with other keys, edges
of unknown endpoints are left out.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from citeweave.session import ensure_checkpoint_dir

# The default tolerance and reset probability of the reference call.
DEFAULT_TOL = 1e-4
DEFAULT_RESET = 0.15
# Upper bound on the broadcast list of hot sources.
MAX_HOT_SOURCES = 1_000_000
# Rounds after which their deltas are added to the state and the state is written.
ROUNDS_PER_FOLD = 16


@dataclass
class PageRankResult:
    ranks: DataFrame  # (id, pr, in_deg, out_deg) for every vertex
    rounds: int  # rounds in which messages were sent
    vertices: int
    partitions: int = 0
    salted: bool = False


def layout_partitions(n_edges: int, cores: int, n_vertices: int = 0, min_rows_per_task: int = 50_000,
                      rows_per_partition: int = 2_000_000, edges_per_partition: int = 16_000_000) -> int:
    """Partitions of the edge layout: use every core once each task gets at
    least ``min_rows_per_task`` rows, and beyond that keep partitions near
    ``rows_per_partition`` vertices (about 50 MB of fixed-width rows) and
    ``edges_per_partition`` edges. Every partition sends a row for each vertex it
    cites, so a round's shuffle grows with the partitions until it has a row for
    each edge: partitions are for memory only once there is one for each core."""
    by_cores = min(cores, -(-max(n_edges, n_vertices) // min_rows_per_task))
    by_size = max(-(-n_edges // edges_per_partition), -(-n_vertices // rows_per_partition))
    # At least two: with one partition Spark plans the layout as a single
    # partition, and every other round's deltas no longer line up with it.
    return max(min(2, cores), by_cores, by_size)


def out_degrees_by_source(edges: DataFrame) -> DataFrame:
    """(src, k): out-edges per source, parallel edges included (partial
    aggregation before the shuffle)."""
    return edges.groupBy("src").agg(F.count("*").alias("k"))


def hot_sources(per_src: DataFrame, edges_per_bucket: int) -> DataFrame:
    """(src, buckets) for sources with more than ``edges_per_bucket`` edges.
    At most (edges / edges_per_bucket) rows: a proven bound, so it may be
    broadcast."""
    return per_src.where(F.col("k") > F.lit(edges_per_bucket)).select(
        "src", F.ceil(F.col("k") / F.lit(edges_per_bucket)).cast("int").alias("buckets"))


def edge_layout(edges: DataFrame, per_src: DataFrame, hot: DataFrame | None, partitions: int) -> DataFrame:
    """(src[, sub], dst, m, w) hash-partitioned on the join keys.

    Parallel edges are folded first, with map-side partial aggregation, so
    copies of one (src, dst) pair collapse before any shuffle; the folded
    pairs are then partitioned on the source (and bucket) and weighted
    w = m / k, with k joined on the same keys.
    """
    folded = edges.groupBy("src", "dst").agg(F.count("*").alias("m"))
    if hot is None:
        laid = folded.repartition(partitions, "src")
        # Hash join built on the degree side: the edge rows are not sorted.
        return laid.join(per_src.hint("shuffle_hash"), "src").select(
            "src", "dst", "m", (F.col("m") / F.col("k")).alias("w"))
    with_sub = folded.join(F.broadcast(hot), "src", "left").select(
        "src", "dst", "m", F.pmod(F.xxhash64("dst"), F.coalesce("buckets", F.lit(1))).cast("int").alias("sub"))
    laid = with_sub.repartition(partitions, "src", "sub")
    # k replicated to each bucket of a hot source, so the join keys match the layout.
    per_bucket = per_src.join(F.broadcast(hot), "src", "left").select(
        "src", "k", F.explode(F.sequence(F.lit(0), F.coalesce("buckets", F.lit(1)) - 1)).alias("sub"))
    return laid.join(per_bucket.hint("shuffle_hash"), ["src", "sub"]).select(
        "src", "sub", "dst", "m", (F.col("m") / F.col("k")).alias("w"))


# One loop session per (caller session, partition count); its settings never
# change after creation, so concurrent loops may share it.
_LOOP_SESSIONS = WeakKeyDictionary()
_LOOP_LOCK = threading.Lock()


def loop_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of the same application for the PageRank loop, with
    adaptive execution off and ``partitions`` shuffle partitions. The
    caller's session configuration is never changed, so concurrent work in
    it (or a second graph built at the same time) is unaffected."""
    with _LOOP_LOCK:
        of_session = _LOOP_SESSIONS.setdefault(spark, {})
        key = (spark.sparkContext.applicationId, partitions)
        session = of_session.get(key)
        if session is None:
            session = spark.newSession()
            session.conf.set("spark.sql.adaptive.enabled", "false")
            session.conf.set("spark.sql.shuffle.partitions", str(partitions))
            of_session[key] = session
    return session


def hand_over(df: DataFrame, session: SparkSession, views: list[str]) -> DataFrame:
    """The same data as a frame of ``session`` (through a global temporary
    view, whose name is appended to ``views`` for clean-up)."""
    name = f"citeweave_{uuid.uuid4().hex}"
    df.createOrReplaceGlobalTempView(name)
    views.append(name)
    database = session.conf.get("spark.sql.globalTempDatabase", "global_temp")
    return session.table(f"{database}.{name}")


def _messages(delta: DataFrame, wedges: DataFrame, hot: DataFrame | None, tol: float, damp: float) -> DataFrame:
    """One round: (id, delta) of every vertex receiving a message."""
    senders = delta.where(F.col("delta") > F.lit(tol)).select(F.col("id").alias("src"), "delta")
    keys = ["src"]
    if hot is not None:
        senders = senders.join(F.broadcast(hot), "src", "left").select(
            "src", "delta", F.explode(F.sequence(F.lit(0), F.coalesce("buckets", F.lit(1)) - 1)).alias("sub"))
        keys = ["src", "sub"]
    return (
        senders.hint("shuffle_hash").join(wedges, keys)
        .groupBy("dst")
        .agg((F.sum(F.col("delta") * F.col("w")) * F.lit(damp)).alias("delta"))
        .withColumnRenamed("dst", "id")
    )


def _first_state(vertices: DataFrame, wedges: DataFrame, per_src: DataFrame, partitions: int, tol: float, reset: float, damp: float) -> DataFrame:
    """(id, out_deg, in_deg, rank, delta) after round one. All vertices send ``reset`` or,
    below the tolerance, none."""
    sent = F.sum(F.lit(reset) * F.col("w")) * F.lit(damp) if reset > tol else F.lit(None).cast("double")
    first = wedges.groupBy(F.col("dst").alias("id")).agg(F.sum("m").alias("in_deg"), sent.alias("delta"))
    degrees = per_src.select(F.col("src").alias("id"), F.col("k").alias("out_deg"))
    # The same hash partitioning as the edge layout, whatever partitioning the vertices come with.
    return vertices.repartition(partitions, "id").distinct().join(first.hint("shuffle_hash"), "id", "left").join(degrees.hint("shuffle_hash"), "id", "left").select(
        "id", F.coalesce("out_deg", F.lit(0)).cast("bigint").alias("out_deg"), F.coalesce("in_deg", F.lit(0)).cast("bigint").alias("in_deg"),
        (F.lit(reset) + F.coalesce("delta", F.lit(0.0))).alias("rank"), "delta")


def _folded(state: DataFrame, deltas: list[DataFrame]) -> DataFrame:
    """The state after the rounds that gave ``deltas``; all inputs are partitioned alike, so nothing moves."""
    rank = F.col("rank")
    for k, delta in enumerate(deltas):
        state = state.join(delta.select("id", F.col("delta").alias(f"d{k}")).hint("shuffle_hash"), "id", "left")
        rank = rank + F.coalesce(f"d{k}", F.lit(0.0))
    return state.select("id", "out_deg", "in_deg", rank.alias("rank"), F.col(f"d{len(deltas) - 1}").alias("delta"))


def _drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a checkpointed frame that nothing reads any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pagerank(vertices: DataFrame, edges: DataFrame, tol: float = DEFAULT_TOL, reset: float = DEFAULT_RESET,
             max_rounds: int | None = None, edges_per_bucket: int = 1_000_000,
             partitions: int | None = None, dense_ids: bool | None = None,
             rounds_per_fold: int = ROUNDS_PER_FOLD) -> PageRankResult:
    """Rank every vertex of ``vertices`` (column ``id``) over ``edges``
    (``src``, ``dst``; one row per edge, parallel rows allowed).

    ``partitions`` for the edge layout defaults to ``layout_partitions``.
    ``dense_ids`` maps keys to bigint surrogates first (default: when the key
    is not an integer type). With ``max_rounds``, raises if the propagation has
    not stopped by then; without it the tolerance alone ends the loop.
    """
    spark = vertices.sparkSession
    ensure_checkpoint_dir(spark)
    if dense_ids is None:
        dense_ids = not isinstance(vertices.schema["id"].dataType, T.IntegralType)
    if dense_ids:
        # Unique, not ordered: a surrogate join key only. Checkpointed, so a
        # recomputation can never hand out different numbers.
        index = vertices.select("id").distinct().withColumn("vid", F.monotonically_increasing_id()) \
            .checkpoint(eager=True)
        src = index.select(F.col("id").alias("src"), F.col("vid").alias("s"))
        dst = index.select(F.col("id").alias("dst"), F.col("vid").alias("d"))
        long_edges = edges.join(src, "src").join(dst, "dst").select(F.col("s").alias("src"), F.col("d").alias("dst"))
        res = pagerank(index.select(F.col("vid").alias("id")), long_edges, tol, reset, max_rounds,
                       edges_per_bucket, partitions, dense_ids=False, rounds_per_fold=rounds_per_fold)
        back = index.select(F.col("vid").alias("id"), F.col("id").alias("key"))
        ranks = res.ranks.join(back, "id").select(F.col("key").alias("id"), "pr", "in_deg", "out_deg")
        return PageRankResult(ranks, res.rounds, res.vertices, res.partitions, res.salted)

    vertices = vertices.select(F.col("id").cast("bigint").alias("id"))
    edges = edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
    run = uuid.uuid4().hex[:12]  # observation names stay unique across concurrent loops
    obs_e = Observation(f"pagerank-{run}-edges")
    per_src = out_degrees_by_source(edges).observe(
        obs_e, F.sum("k").alias("n"), F.max("k").alias("top")).checkpoint(eager=True)
    stats = obs_e.get
    n_edges, top = int(stats["n"] or 0), int(stats["top"] or 0)
    # The hot list has at most n_edges / edges_per_bucket rows; keep that
    # bound under MAX_HOT_SOURCES so broadcasting it is always safe.
    edges_per_bucket = max(edges_per_bucket, -(-n_edges // MAX_HOT_SOURCES))
    salted = top > edges_per_bucket
    n_parts = partitions or layout_partitions(n_edges, spark.sparkContext.defaultParallelism, vertices.count())
    hot = hot_sources(per_src, edges_per_bucket).checkpoint(eager=True) if salted else None

    loop = loop_session(spark, n_parts)
    views: list[str] = []
    wedges = None
    deltas: list[DataFrame] = []
    damp = 1.0 - reset
    try:
        # Reliable copy first (survives executor loss), then kept on the
        # executors: every round scans the whole layout, so it is read from
        # memory / local disk rather than from the shared folder each time.
        per_src_l = hand_over(per_src, loop, views)
        hot_l = hand_over(hot, loop, views) if salted else None
        wedges = edge_layout(hand_over(edges, loop, views), per_src_l, hot_l, n_parts).checkpoint(eager=True)
        wedges = wedges.persist(StorageLevel.MEMORY_AND_DISK)
        seen = Observation(f"pagerank-{run}-1")
        sends = F.count(F.when(F.col("delta") > F.lit(tol), 1)).alias("active")
        state = _first_state(hand_over(vertices, loop, views), wedges, per_src_l, n_parts, tol, reset, damp).observe(
            seen, F.count("*").alias("n"), F.count("delta").alias("received"), sends).checkpoint(eager=True)
        n_vertices = int(seen.get["n"])

        def fold() -> None:
            nonlocal state, deltas
            before, state = state, _folded(state, deltas).checkpoint(eager=True)
            for df in [before, *deltas]:
                _drop_checkpoint(df)
            deltas = []

        delta, rounds = state.select("id", "delta"), 0
        while int(seen.get["received"] or 0):  # else nothing was sent: only sinks were above the tolerance
            rounds += 1
            if not int(seen.get["active"] or 0):
                break
            if max_rounds is not None and rounds >= max_rounds:
                raise RuntimeError(f"PageRank did not converge within {max_rounds} rounds")
            if len(deltas) == rounds_per_fold:
                fold()
                delta = state.select("id", "delta")
            seen = Observation(f"pagerank-{run}-{rounds + 1}")
            delta = _messages(delta, wedges, hot_l, tol, damp).observe(seen, F.count("delta").alias("received"), sends).checkpoint(eager=True)
            deltas.append(delta)
        if deltas:
            fold()
        total = float(state.agg(F.sum("rank").alias("mass")).first()["mass"] or 0.0)
        ranks = hand_over(state, spark, views)
    finally:
        if wedges is not None:
            wedges.unpersist()
        for name in views:
            spark.catalog.dropGlobalTempView(name)
    scale = n_vertices / total if total else 0.0
    ranks = ranks.select("id", (F.col("rank") * F.lit(scale)).alias("pr"), "in_deg", "out_deg")
    return PageRankResult(ranks=ranks, rounds=rounds, vertices=n_vertices, partitions=n_parts, salted=salted)
