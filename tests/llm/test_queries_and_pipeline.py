"""Registered queries against their SQL, and the pipeline against plain Python."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from citeweave.llm import quality
from citeweave.llm.common import id_bucket, keep, table, utf8
from citeweave.llm.queries import QUERIES, SQL
from compare import compare, duck
from pyspark.sql import functions as F
from test_dedup import lines_by_hand, near_by_hand

SF = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, key):
    ok, ours, theirs = compare(spark, SF, keys=[key], con=duck(SF), verbose=False)[key]
    assert ok, (ours, theirs)


@pytest.fixture(scope="module")
def staged(spark):
    """What each stage returns."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in pipeline.STAGES:
        docs = keep(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]


def test_pipeline_by_hand(spark, staged):
    docs = table(spark, SF, "documents")
    model = quality.train(docs, table(spark, SF, "labels").where(id_bucket(F.col("doc_id"), 4) != 2))
    rows = rows_of(docs)
    score = model.scores(quality.features(*utf8(pa.array([t for _, t in rows]))))
    rows = [r for r, s in zip(rows, score) if s >= quality.CUT]
    assert rows == rows_of(staged[0]) and 0 < len(rows) < 200
    rows = sorted((i, t) for i, t, *_ in lines_by_hand(rows))
    assert rows == rows_of(staged[1])
    stays = {i for i, _, _, kept in near_by_hand(rows, 5) if kept}
    rows = [r for r in rows if r[0] in stays]
    assert rows == rows_of(staged[2])
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    bench = [norm(r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = [r for r in rows if not any(b in norm(r[1]) for b in bench)]
    assert rows == rows_of(staged[3])
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, staged[4].collect())) == want


def test_stages_keep_columns(staged, spark):
    want = table(spark, SF, "documents").dtypes
    assert all(df.dtypes == want for df in staged[:-1])
    lengths = staged[1].where(F.char_length("text") != F.col("n_chars")).count()
    assert lengths == table(spark, SF, "documents").where(F.char_length("text") != F.col("n_chars")).count()


def test_run_equals_its_stages(spark, staged):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, staged[-1].collect()))


def test_stages_of_odd_rows(spark, documents, odd_rows, folder):
    """Every stage takes nulls, repeated rows, empty tables and clashing names."""
    labels = spark.createDataFrame([(4, 1), (5, 1), (13, 0), (6, 1), (None, 0)], "doc_id bigint, quality int")
    bench = spark.createDataFrame([(1, "three four five six seven"), (2, None)], "item_id bigint, text string")
    for rows in (odd_rows, []):
        base = folder(labels=labels, benchmark=bench)
        docs = documents(rows)
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, base)
            if name != pipeline.STAGES[-1][0]:
                assert out.dtypes == docs.dtypes, name
            assert out.count() <= len(rows), name
    docs = documents(odd_rows)
    near = [r.doc_id for r in pipeline.keep_one_of_near_copies(spark, docs, base).collect()]
    assert sorted(near, key=repr) == sorted([1, 2, 3, 4, 5, 7, 9, 10, None, None, 11, 12, 13, 14], key=repr)
    clean = [r.doc_id for r in pipeline.drop_contaminated(spark, docs, base).collect()]
    assert sorted(clean, key=repr) == sorted([1, 2, 3, 4, 7, 8, 9, 10, None, 11, 12, 13, 14], key=repr)


def test_near_copies_are_judged_by_row(spark, documents):
    """Rows that repeat an id keep their texts unless the text itself is a copy."""
    one, two, three = ("the quick brown fox jumps over the lazy dog", "quite other words stand in this second text here", "and a third text that has nothing to do with them")
    rows = [(5, None), (5, one), (6, two), (6, three), (6, three), (2, two + "!"), (2, two), (1, two), (7, three), (7, None), (7, None), (7, ""), (None, one),
            (8, "a b c d e f g"), (8, "A b c d e f g")]
    got = [(r.doc_id, r.text) for r in pipeline.keep_one_of_near_copies(spark, documents(rows), "").collect()]
    want = [(5, None), (5, one), (6, three), (1, two), (2, two + "!"), (7, None), (7, ""), (None, one), (8, "A b c d e f g")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entry_works_without_the_operators(tmp_path):
    """With the folder and the pipeline deleted the entry file still imports."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "citeweave"), tmp_path / "citeweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'publication_edges' in q and not [k for k in q if k.startswith('op') or k == 'pipeline']; " \
           "assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
