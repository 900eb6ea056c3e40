"""Physical-plan checks."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_plans(spark):
    q = entry.queries()
    for key in ["publication_edges", "journal_edges", "influence_report_publications", "graph_links",
                "hex_to_decimal", "dense_publication_index", "publication_summary"]:
        plan = _plan(q[key](spark, SF))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert marker not in plan, (key, marker)


def test_scan_prunes_columns(spark):
    """Kept tables are Parquet: a question reads the columns it needs."""
    from citeweave.operators.edges import publication_edges, publication_vertices
    from citeweave.plans.graph import corpus, publication_graph

    pubs = corpus(spark, SF)
    plan = _plan(publication_vertices(pubs))
    assert "ReadSchema: struct<id:string,title:string>" in plan and "ExistingRDD" not in plan, plan
    plan = _plan(publication_edges(pubs))
    assert "ReadSchema: struct<id:string,outCitations:array<string>>" in plan and "ExistingRDD" not in plan, plan
    g = publication_graph(spark, SF)
    assert "ReadSchema: struct<dst:string>" in _plan(g.in_degrees())
    plan = _plan(g.top(5))
    assert "ReadSchema: struct<id:string,name:string,in_deg:bigint,out_deg:bigint,pr:double,position:bigint>" in plan
    assert "LessThan(position,5)" in plan and "TakeOrdered" not in plan
    for key in ("sample_by_hash", "corpus_count", "publication_journal", "dense_journal_index"):
        assert "ExistingRDD" not in _plan(entry.queries()[key](spark, SF)), key


def test_a_report_starts_no_job(spark):
    """Asking a built graph runs nothing until the result is asked for, and the
    seeds' joins run once: their exchange is used for the slot sizes too."""
    from citeweave.plans.graph import publication_graph

    g = publication_graph(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quiet", "building a report")
    try:
        report = g.influence_report(3)
        g.influential("red bolt 12", "either")
        assert not tracker.getJobIdsForGroup("quiet")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    report.collect()
    assert "ReusedExchange" in _plan(report)


def test_lookups_prune_row_groups_and_move_no_edges(spark):
    """Questions about the top vertices are a range on a sorted bigint column of
    the adjacency; the edges are scanned, two columns of them, and not shuffled."""
    from citeweave.plans.graph import publication_graph

    g = publication_graph(spark, SF)
    for df in (g.top_neighbors(5, "either"), g.influence_report(5, "either")):
        plan = _plan(df)
        assert plan.count("LessThan(seed,5)") >= 2, plan
        assert "ReadSchema: struct<seed:bigint,neighbor:bigint>" in plan and "src:string" not in plan
    best = g.top(1).first()
    seeds = spark.createDataFrame([(best.id,)], "seed_id string")
    for df in (g.neighbors(seeds, "in", seeds_bound=1), g.influential([best.name], "in")):
        assert df.collect()
        plan = _plan(df).split("Initial Plan")[0]
        scan = plan.index("ReadSchema: struct<seed:bigint,neighbor:bigint>")
        above = plan[:scan].splitlines()[::-1]
        depth = [len(x) - len(x.lstrip(" :+-*")) for x in above]
        path, least = [], depth[0] + 1
        for line, d in zip(above, depth):  # the scan's ancestors
            if d < least:
                path.append(line)
                least = d
        join = next(i for i, line in enumerate(path) if "Join" in line)
        assert "BroadcastHashJoin" in path[join] and not any("Exchange" in line for line in path[:join]), path[:join + 1]


def test_node_link_is_a_projection(spark):
    from citeweave.plans.graph import publication_graph

    for df in publication_graph(spark, SF).node_link():
        plan = _plan(df)
        assert "Exchange" not in plan and "Join" not in plan and "Sort" not in plan, plan


def test_no_edges_are_aggregated_after_pagerank(spark, monkeypatch):
    """Degrees come with the ranks; the two stored edge tables are sorted by seed."""
    import citeweave.plans.graph as pg
    from citeweave.operators import degrees

    def never(*args):
        raise AssertionError("edges aggregated again")

    monkeypatch.setattr(degrees, "in_degrees", never)
    monkeypatch.setattr(degrees, "out_degrees", never)
    g = pg.build_journal_graph(pg.corpus(spark, SF))
    monkeypatch.undo()
    by_id = {r.id: (r.in_deg, r.out_deg) for r in g.vertices.collect()}
    ins = {r.id: r.in_deg for r in degrees.in_degrees(g.edges).collect()}
    outs = {r.id: r.out_deg for r in degrees.out_degrees(g.edges).collect()}
    assert by_id == {k: (ins.get(k, 0), outs.get(k, 0)) for k in by_id}
    places = {r.node: r.position for r in g.vertices.collect()}
    pairs = sorted((places[r.src_node], places[r.dst_node]) for r in g.edges.collect())
    assert sorted((r.neighbor, r.seed) for r in g.adjacent.incoming.collect()) == pairs
    assert sorted((r.seed, r.neighbor) for r in g.adjacent.outgoing.collect()) == pairs


def test_pagerank_keeps_few_states(spark, monkeypatch):
    """At no time more than ``rounds_per_fold`` deltas and two states are in the
    checkpoint folder, however many rounds there are; results do not depend on it."""
    import citeweave.operators.pagerank as pm

    edges = spark.createDataFrame([(i, (i * 7 + k) % 60) for i in range(60) for k in range(1, 3)], "src bigint, dst bigint")
    vertices = edges.select(edges["src"].alias("id")).distinct()
    plain = pm.pagerank(vertices, edges, tol=0.02, rounds_per_fold=1000)
    written, dropped, most = [0], [0], [0]
    original, drop = pm._messages, pm._drop_checkpoint

    def messages(*args):
        written[0] += 1
        most[0] = max(most[0], written[0] - dropped[0])
        return original(*args)

    def dropping(df):
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
        drop(df)
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        dropped[0] += 1

    monkeypatch.setattr(pm, "_messages", messages)
    monkeypatch.setattr(pm, "_drop_checkpoint", dropping)
    folded = pm.pagerank(vertices, edges, tol=0.02, rounds_per_fold=3)
    assert folded.rounds == plain.rounds > 9 and most[0] <= 4
    a, b = ({r.id: (r.pr, r.in_deg, r.out_deg) for r in x.ranks.collect()} for x in (plain, folded))
    assert a.keys() == b.keys() and all(abs(a[k][0] - b[k][0]) < 1e-12 and a[k][1:] == b[k][1:] for k in a)


def test_dropped_graphs_leave_no_files(spark):
    import glob

    from citeweave.plans.graph import build_journal_graph, corpus

    g = build_journal_graph(corpus(spark, SF))
    paths = [f._kept_path.replace("file:", "") for f in (g.vertices, g.edges) if hasattr(f, "_kept_path")]
    assert paths and all(glob.glob(f"{p}/*.parquet") for p in paths)
    g.unpersist()
    assert not any(glob.glob(f"{p}/*") for p in paths)


def test_sparse_graphs_get_partitions_for_their_vertices():
    from citeweave.operators.pagerank import layout_partitions

    assert layout_partitions(1_000, 8) == 2
    assert layout_partitions(1_000, 8, 1_000_000_000) == 500
    assert layout_partitions(1_000_000, 400, 30_000_000) == 400


def test_pagerank_round_moves_only_messages(spark):
    """A round joins deltas to the edge layout without an exchange; the only
    shuffle is the message sum. With hot sources, the small delta side is
    shuffled to (src, sub) but the edge table still stays in place. The
    loop's session settings never leak into the caller's session."""
    from pyspark.sql import functions as F
    from pyspark.storagelevel import StorageLevel

    from citeweave.operators.pagerank import (_messages, edge_layout, hand_over, hot_sources, loop_session,
                                              out_degrees_by_source)

    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    edges = spark.createDataFrame([(i % 97, (i * 31) % 101) for i in range(3000)], "src bigint, dst bigint")
    per_src = out_degrees_by_source(edges).checkpoint()
    for per_bucket in [1_000_000, 5]:
        hot = hot_sources(per_src, per_bucket).checkpoint() if per_bucket < 100 else None
        loop, views = loop_session(spark, 4), []
        e_l, d_l = hand_over(edges, loop, views), hand_over(per_src, loop, views)
        h_l = hand_over(hot, loop, views) if hot is not None else None
        layout = edge_layout(e_l, d_l, h_l, 4)
        lp = _plan(layout)
        # fold (after partial aggregation), layout, degrees; no sort of the edge rows
        assert lp.count("Exchange hashpartitioning") == 3, lp
        assert "partial_count" in lp and "SortMergeJoin" not in lp
        w = layout.checkpoint().persist(StorageLevel.MEMORY_AND_DISK)  # as the loop keeps it
        d = loop.range(0, 101).select(F.col("id"), F.lit(0.15).alias("delta")).repartition(4, "id").checkpoint()
        plan = _plan(_messages(d, w, h_l, 1e-4, 0.85))
        exchanges = plan.count("Exchange hashpartitioning")
        assert exchanges == (2 if hot is not None else 1), plan
        assert "hashpartitioning(dst" in plan
        w.unpersist()
        for name in views:
            spark.catalog.dropGlobalTempView(name)
    assert spark.conf.get("spark.sql.adaptive.enabled") == aqe


def test_dense_index_has_no_data_sized_single_partition(spark):
    """The data never passes through a single partition: the one
    single-partition step (offsets over one row per partition) is
    materialised on its own, and the positions plan only broadcasts it."""
    from citeweave.operators.indexing import dense_index

    df = spark.range(0, 5000).selectExpr("cast(id as string) id")
    plan = _plan(dense_index(df, ["id"], partitions=4))
    assert "SinglePartition" not in plan
    assert "Window" not in plan
    assert "BroadcastExchange" in plan
    assert "_metadata" in plan and "Aggregate" not in plan  # positions come with the read


def test_quarantine_keeps_no_line_of_good_records(spark, tmp_path):
    from pyspark.sql import functions as F

    from citeweave.sources.jsonl import scan_with_quarantine

    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"id":"a","title":"t","unused":1,"journalName":"j","outCitations":["b"]}',), ('{"id":"b"',), ("{}",)], "value string").write.text(path)
    good, bad = scan_with_quarantine(spark, path)
    assert [tuple(r) for r in good.collect()] == [("a", "t", "j", ["b"])]
    assert sorted(tuple(r) for r in bad.collect()) == [("malformed", "b", '{"id":"b"'), ("missing_id", None, "{}")]
    assert "PartitionFilters: [isnotnull(quarantined" in _plan(good)
    files = good.select(F.input_file_name().alias("f")).first().f
    stored = spark.read.parquet(files.rsplit("/", 1)[0])
    assert stored.where("line is not null").count() == 0 and "record" not in stored.columns


def test_every_round_of_a_real_build_has_one_exchange(spark, monkeypatch):
    """Across all rounds of an actual build, deltas stay aligned with the
    edge layout: one exchange (the message sum) per round, never more."""
    import citeweave.operators.pagerank as pm
    from citeweave.plans.graph import build_publication_graph, corpus

    plans = []
    original = pm._messages

    def watched(*args, **kwargs):
        df = original(*args, **kwargs)
        plans.append(_plan(df))
        return df

    monkeypatch.setattr(pm, "_messages", watched)
    g = build_publication_graph(corpus(spark, SF))
    # Round one is part of the first state and needs no join; a last round may send nothing.
    assert g.rounds > 10 and len(plans) + 1 in (g.rounds, g.rounds + 1)
    assert all(p.count("Exchange") == 1 for p in plans), [p.count("Exchange") for p in plans]


def test_edges_by_position_are_written_when_asked_for(spark):
    from citeweave.plans.graph import build_publication_graph, corpus

    g = build_publication_graph(corpus(spark, SF))
    assert g.lookups is None and g.vertices.count() and g.node_link()[1].count() and g.lookups is None
    assert g.top_neighbors(2).count() and g.lookups is not None
    g.unpersist()


def test_layout_has_no_more_partitions_than_cores_until_memory_needs_them():
    """A round's shuffle has a row for each partition and vertex that it cites."""
    from citeweave.operators.pagerank import layout_partitions

    assert layout_partitions(68_000_000, 12, 1_260_000) == 12
    assert layout_partitions(410_000_000, 12, 7_560_000) == 26
