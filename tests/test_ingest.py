"""JSON-lines scan: strict and permissive modes, quarantine, round trip."""

import os
import tempfile

import pytest

from citeweave.sources import jsonl
from citeweave.sources.corpus import as_records

GOOD = '{"id": "a1", "title": "T", "journalName": "J", "outCitations": ["b2"], "year": 2001}'
LINES = [
    GOOD,
    '{"id": "b2", "title": "U", "journalName": "", "outCitations": [], "yea',  # truncated
    "{}",
    '{"id": "c3", "title": "V", "journalName": "J", "outCitations": [], "year": "x"}',  # wrong type
    '{"id": "d4", "title": null, "journalName": "J", "outCitations": ["a1"]}',
    '{"id": "e5", "title": "W", "journalName": "K"}',  # no outCitations
]


@pytest.fixture(scope="module")
def path():
    d = tempfile.mkdtemp(prefix="citeweave-json-")
    with open(os.path.join(d, "part-0.json"), "w") as f:
        f.write("\n".join(LINES) + "\n")
    return d


@pytest.fixture
def one_line(tmp_path):
    def of(*lines):
        (tmp_path / "part.json").write_text("\n".join(lines) + "\n")
        return str(tmp_path)
    return of


@pytest.mark.parametrize("line", ["{}", '{"id": "x", "year": "abc"}', '{"id": "x", "authors": 3}', '{"id": "x", "title"', '{"title": "T"}', "[1]", "text"])
def test_failfast_raises_on_each(spark, one_line, line):
    """Also for fields that nobody selects, and with a good record beside."""
    with pytest.raises(Exception, match="record"):
        jsonl.read_publications(spark, one_line(GOOD, line), mode="FAILFAST").collect()
    assert [r.id for r in jsonl.read_publications(spark, one_line(GOOD, line), mode="PERMISSIVE").collect()] == ["a1"]


def test_failfast_takes_good_lines(spark, one_line):
    assert [r.id for r in jsonl.read_publications(spark, one_line(GOOD, "", "  ")).collect()] == ["a1"]


def test_permissive_drops_bad_records(spark, path):
    for mode in ("PERMISSIVE", "DROPMALFORMED"):
        assert sorted(r.id for r in jsonl.read_publications(spark, path, mode=mode).collect()) == ["a1", "d4", "e5"]


def test_quarantine(spark, path):
    good, bad = jsonl.scan_with_quarantine(spark, path)
    assert sorted((r.reason, r.recovered_id or "", r.line) for r in bad.collect()) == \
        [("malformed", "b2", LINES[1]), ("malformed", "c3", LINES[3]), ("missing_id", "", "{}")]
    got = {r.id: r for r in good.collect()}
    assert sorted(got) == ["a1", "d4", "e5"]
    assert got["d4"].title is None
    assert got["e5"].outCitations is None


def test_round_trip(spark, toy):
    d = tempfile.mkdtemp(prefix="citeweave-rt-")
    out = os.path.join(d, "corpus")
    jsonl.write_json_lines(as_records(toy), out)
    back = jsonl.read_publications(spark, out, mode="FAILFAST")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, toy.collect()))
    full = jsonl.read_publications(spark, out, columns=None)
    assert len(full.columns) == 19


def test_batch_is_not_kept_between_its_outputs(spark, tmp_path, monkeypatch):
    """Parsed records of a batch are several times its files: they are not persisted."""
    from citeweave.sources.jsonl import parse_lines
    from citeweave.streaming.ingest import _split_batch

    batch = parse_lines(spark.createDataFrame([('{"id":"a","outCitations":["b"]}',), ('{"id":"b"',), ("{}",)], "value string"))

    def never(*_, **__):
        raise AssertionError("a batch was persisted")

    monkeypatch.setattr(type(batch), "persist", never)
    _split_batch(str(tmp_path / "table"), str(tmp_path / "quarantine"))(batch, 0)
    assert [(r.id, r.outCitations) for r in spark.read.parquet(str(tmp_path / "table")).collect()] == [("a", ["b"])]
    assert sorted(r.reason for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()) == ["malformed", "missing_id"]


def test_damaged_lines_are_written_compressed(spark):
    from citeweave.plans.catalog import _damaged_json

    files = spark.read.text(_damaged_json(spark, "/root/testdata/sf0.001")).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
