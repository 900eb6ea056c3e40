import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave.llm import periodic_runs as runs
from citeweave.llm.common import slices
from citeweave.llm.queries import QUERIES
from conftest import SF


def brute_runs(words, least=12):
    """Every stretch of every period, tried one by one."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            run = words[i:j + q]
            if len(run) >= max(least, 2 * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words, found):
    gone = {k for start, length, period in found for k in range(start + period, start + length)}
    return [w for k, w in enumerate(words) if k not in gone]


def found_runs(texts, least=12):
    out = []
    for raw, offsets in slices(pa.array(texts, pa.string())):
        words, ends = runs.word_hashes(raw, offsets)
        found = [[] for _ in offsets[1:]]
        for text, *run in zip(*(x.tolist() for x in runs.find_runs(words, ends, least))):
            found[text].append(tuple(run))
        out += found
    return out


@st.composite
def texts_of_words(draw):
    words = draw(st.lists(st.sampled_from("abc"), max_size=40))
    if words and draw(st.booleans()):  # periodic from somewhere on
        a = draw(st.integers(0, len(words) - 1))
        p = draw(st.integers(1, len(words) - a))
        n = draw(st.integers(len(words), 70))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(texts_of_words(), max_size=5), st.sampled_from([4, 7, 12]))
def test_runs_equal_brute_force(docs, least):
    assert found_runs([" ".join(w) for w in docs], least) == [brute_runs(w, least) for w in docs]


def test_suffix_order_and_lcp():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, 300).astype(np.uint64)
    chosen = np.flatnonzero(runs._repeated(words, np.array([0, 300]), 4))
    order, lcp = runs._sorted_suffixes(words, np.zeros(300, np.int64), np.full(300, 300), chosen, 4)
    w = words.tolist()
    assert order.tolist() == sorted(chosen.tolist(), key=lambda i: w[i:])
    for (a, b), common in zip(zip(order[:-1].tolist(), order[1:].tolist()), lcp[1:].tolist()):
        true = next((k for k in range(300) if max(a, b) + k == 300 or w[a + k] != w[b + k]), 300)
        assert common == (true if true >= 4 else 0)


def test_known_shapes():
    one = [f"u{i}" for i in range(30)]
    assert found_runs(["ab " * 300, " ".join("abc" * 7), " ".join(one + one), " ".join(one + one[:29]), " ".join("ab" * 5 + "b"), "ab " * 11]) == \
        [[(0, 300, 1)], [(0, 21, 3)], [(0, 60, 30)], [], [], []]
    # One word may be in several runs.
    nested = ("a b " * 7 + "c ") * 3
    assert found_runs([nested])[0] == brute_runs(nested.split())
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    assert found_runs([long, "x"]) == [[(0, 60_000, 700)], []]


def test_rows_of_all_kinds(documents, odd_rows):
    docs = documents(odd_rows)
    got = docs.select("doc_id", "text", runs.collapse_runs(docs["text"]).alias("r")).collect()
    assert len(got) == len(odd_rows)
    for doc_id, text, r in got:
        words = (text or "").encode().split()
        if len(words) < 2000:
            found = brute_runs(words)
            assert [tuple(x) for x in r.runs] == found
            assert r.collapsed.encode() == b" ".join(kept_words(words, found))
        else:
            assert [tuple(x) for x in r.runs] == [(0, 60_000, 9973)]  # squares modulo 9973
            assert r.collapsed.encode() == b" ".join(words[:9973] + words[60_000:])
        assert r.n_words == len(words)
    empty = documents([]).select(runs.collapse_runs(F.col("text")).alias("r"))
    assert empty.collect() == [] and empty.schema["r"].dataType.simpleString() == runs.RESULT


@pytest.fixture(scope="module")
def answers(spark):
    return QUERIES["op13_periodic_runs"](spark, SF)


def test_query_equals_brute_force(spark, answers):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = answers.collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    made = 0
    for r in got:
        words = (texts[r.doc_id] or "").encode().split()
        if len(words) > 600:
            continue
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            made += 1
        found = brute_runs(words)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(kept_words(words, found))).hexdigest()
    assert made > 5


def test_query_on_odd_rows(documents, folder, odd_rows):
    made = [(i, " ".join(f"x{k}" for k in range(n))) for i, n in zip(range(100, 180), range(80))]
    base = folder(documents=documents(odd_rows + made))
    got = QUERIES["op13_periodic_runs"](documents([]).sparkSession, base).collect()
    assert len(got) == len(odd_rows) + len(made)
    empty = folder(documents=documents([]))
    assert QUERIES["op13_periodic_runs"](documents([]).sparkSession, empty).count() == 0


def test_no_shuffle(answers):
    plan = answers._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
