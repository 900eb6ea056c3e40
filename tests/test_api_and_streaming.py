"""User-facing graph API, corpus loading, test mode, sinks and streaming ingest."""

import json
import os
import tempfile

import pytest

from citeweave.plans.graph import build_journal_graph, build_publication_graph, load_corpus
from citeweave.plans.testmode import run_test_mode
from citeweave.sources import jsonl
from citeweave.sources.corpus import as_records
from citeweave.streaming.ingest import start_ingest


@pytest.fixture(scope="module")
def toy_path(toy):
    d = tempfile.mkdtemp(prefix="citeweave-api-")
    jsonl.write_json_lines(as_records(toy), os.path.join(d, "corpus"))
    return os.path.join(d, "corpus")


def test_load_and_search_by_name(spark, toy_path):
    pubs = load_corpus(spark, toy_path)
    g = build_publication_graph(pubs)
    rows = sorted(g.influential("B", "either").collect(), key=lambda r: (r.seed_id, r.rank))
    # "B" names two publications (2 and 6), each keyed by seed_id
    assert {r.seed_id for r in rows} == {"2", "6"}
    assert [r.neighbor_id for r in rows if r.seed_id == "2"] == ["3", "3", "1"]
    assert g.influential("no such title").count() == 0
    assert [r.id for r in g.top(2).orderBy("position").collect()] == ["3", "1"]


def test_sampled_load_is_stable(spark, toy_path):
    a = {r.id for r in load_corpus(spark, toy_path, sample=0.5).collect()}
    b = {r.id for r in load_corpus(spark, toy_path, sample=0.5, partitions=3).collect()}
    assert a == b


def test_node_link_export(spark, toy):
    g = build_publication_graph(toy)
    out = tempfile.mkdtemp(prefix="citeweave-nl-")
    g.write_node_link(out)
    nodes = spark.read.json(f"{out}/nodes")
    links = spark.read.json(f"{out}/links")
    assert sorted((r.idx, r.id) for r in nodes.collect()) == [(i, str(i + 1)) for i in range(6)]
    assert sorted((r.source, r.target) for r in links.collect()) == \
        sorted([(0, 1), (0, 2), (1, 2), (1, 2), (3, 3), (3, 0), (5, 0)])


def test_test_mode_and_csv_sink(spark, toy):
    out = tempfile.mkdtemp(prefix="citeweave-tm-")
    res = run_test_mode(toy, 2, 2, output=os.path.join(out, "reports"))
    assert res["rounds"]["publications"] > 0 and res["rounds"]["journals"] > 0
    pub = spark.read.json(os.path.join(out, "reports", "publications_report"))
    assert pub.where("seed_position = 1").count() == 3  # vertex 3 is cited by 1, 2, 2
    jsonl.write_csv(res["reports"]["publications"], os.path.join(out, "csv"), single_file=True)
    assert len([f for f in os.listdir(os.path.join(out, "csv")) if f.endswith(".csv")]) == 1
    back = spark.read.option("header", True).csv(os.path.join(out, "csv"))
    assert back.count() == res["reports"]["publications"].count() and back.columns == res["reports"]["publications"].columns


def test_streaming_ingest(spark, toy):
    base = tempfile.mkdtemp(prefix="citeweave-stream-")
    src = os.path.join(base, "incoming")
    os.makedirs(src)
    lines = [r.value for r in jsonl.to_json_lines(as_records(toy)).collect()]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(lines[:3]) + "\n")
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write("\n".join(lines[3:]) + "\n" + '{"id": "x9", "title": "broken' + "\n" + "{}\n")
    q = start_ingest(spark, src, os.path.join(base, "table"), os.path.join(base, "quarantine"),
                     os.path.join(base, "ckpt"), files_per_batch=1)
    q.awaitTermination(120)
    table = spark.read.parquet(os.path.join(base, "table"))
    assert sorted(r.id for r in table.collect()) == ["1", "2", "3", "4", "5", "6"]
    assert table.select("batch").distinct().count() == 2
    bad = sorted((r.reason, r.recovered_id) for r in spark.read.parquet(os.path.join(base, "quarantine")).collect())
    assert bad == [("malformed", "x9"), ("missing_id", None)]
    kept = {r.line for r in spark.read.parquet(os.path.join(base, "quarantine")).collect()}
    assert kept == {'{"id": "x9", "title": "broken', "{}"}
    g = build_journal_graph(table.drop("batch"))
    assert sorted((r.src, r.dst, r.n) for r in g.edges.collect()) == [("J1", "J2", 3), ("J3", "J1", 1)]


def test_command_line_search(spark, toy_path, capsys, monkeypatch):
    from citeweave import __main__ as cli

    out = tempfile.mkdtemp(prefix="citeweave-cli-")
    monkeypatch.setattr(spark, "stop", lambda: None)
    assert cli.main(["search", "--input", toy_path, "--name", "C", "--direction", "in",
                     "--output", os.path.join(out, "r")]) == 0
    rows = spark.read.json(os.path.join(out, "r")).collect()
    assert sorted(r.neighbor_id for r in rows) == ["1", "2", "2"]


def test_command_line_search_prints_every_row(spark, tmp_path, capsys, monkeypatch):
    from citeweave import __main__ as cli

    rows = [("hub", "Hub", "J", [])] + [(f"c{i:03d}", f"T{i}", "K", ["hub"]) for i in range(120)]
    pubs = spark.createDataFrame(rows, "id string, title string, journalName string, outCitations array<string>")
    jsonl.write_json_lines(as_records(pubs), str(tmp_path / "in"))
    monkeypatch.setattr(spark, "stop", lambda: None)
    assert cli.main(["search", "--input", str(tmp_path / "in"), "--name", "Hub"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 121
    assert cli.main(["search", "--input", str(tmp_path / "in"), "--name", "Hub", "--show", "7"]) == 0
    printed = capsys.readouterr().out.splitlines()
    assert len(printed) == 9 and printed[-1] == "of 120 rows"


def test_command_line_report_from_properties(spark, toy_path, capsys, monkeypatch):
    from citeweave import __main__ as cli

    out = tempfile.mkdtemp(prefix="citeweave-props-")
    props = os.path.join(out, "run.properties")
    with open(props, "w") as fh:
        fh.write(f"""# a run configuration
env = local
file.path = {toy_path}
sample.size = 1.0
repartition.size = 4
test.mode = true
test.entity.publication = true
test.entity.journal = false
test.publication.size = 2
test.journal.size = 5
test.print.results = true
""")
    monkeypatch.setattr(spark, "stop", lambda: None)
    assert cli.main(["report", "--properties", props, "--output", os.path.join(out, "r")]) == 0
    printed = capsys.readouterr().out
    summary = json.loads(printed.splitlines()[0])
    assert set(summary["rounds"]) == {"publications"}
    rows = spark.read.json(os.path.join(out, "r", "publications_report")).collect()
    assert {r.seed_position for r in rows} == {1, 2}
    assert "most influential citing vertices" in printed


def test_graph_write_and_read(spark, toy):
    from citeweave.plans.graph import CitationGraph

    g = build_publication_graph(toy)
    out = os.path.join(tempfile.mkdtemp(prefix="citeweave-save-"), "g")
    g.write(out)
    back = CitationGraph.read(spark, out)
    assert back.kind == "publication" and back.rounds == g.rounds
    assert sorted(map(tuple, back.vertices.collect())) == sorted(map(tuple, g.vertices.collect()))
    assert [r.neighbor_id for r in back.influential("C", "in").orderBy("rank").collect()] == ["1", "2", "2"]


def test_search_on_a_saved_graph(spark, toy_path, tmp_path, capsys, monkeypatch):
    """``report --save`` keeps the graphs; ``search --graph-path`` asks one of them and builds nothing."""
    import citeweave.plans.graph as pg
    from citeweave import __main__ as cli

    monkeypatch.setattr(spark, "stop", lambda: None)
    assert cli.main(["report", "--input", toy_path, "--publications", "2", "--journals", "0", "--sample", "1.0", "--bernoulli",
                     "--save", str(tmp_path), "--csv", str(tmp_path / "csv")]) == 0
    assert set(json.loads(capsys.readouterr().out.splitlines()[0])["rounds"]) == {"publications"}

    def never(*args, **kwargs):
        raise AssertionError("a graph was built")

    monkeypatch.setattr(pg, "build_publication_graph", never)
    assert cli.main(["search", "--graph-path", str(tmp_path / "publications"), "--name", "C"]) == 0
    printed = capsys.readouterr().out.splitlines()
    assert [line.split("\t")[3] for line in printed[1:]] == ["1", "2", "2"]
    from citeweave.sources.jsonl import read_csv

    report = pg.CitationGraph.read(spark, str(tmp_path / "publications")).influence_report(2)
    again = read_csv(spark, str(tmp_path / "csv" / "publications_report"), report.schema)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, report.collect()))


def test_csv_keeps_values_apart(spark, tmp_path):
    from citeweave.sources.jsonl import read_csv, write_csv

    rows = [("a", 1, 0.5), ("", 2, None), (None, 3, 1e-9), ('say "x", \\ y', 4, 2.0), (" two\nlines ", None, 1.0)]
    df = spark.createDataFrame(rows, "s string, n bigint, x double")
    again = read_csv(spark, write_csv(df, str(tmp_path / "c")), df.schema)
    key = repr
    assert sorted(map(tuple, again.collect()), key=key) == sorted(rows, key=key) and again.schema == df.schema
