"""Quality, language, licences and decontamination: held-out accuracy, brute force, odd rows."""

import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeweave.llm import decontaminate, language, licenses, quality
from citeweave.llm.common import slices, table, utf8
from citeweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# -- quality ------------------------------------------------------------------

@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op1_bradley_terry"](spark, SF).join(table(spark, SF, "labels"), "doc_id", "left").toPandas()


def test_quality_held_out(scored):
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in scored.doc_id]).all()
    assert (scored.predicted == (scored.score >= 0.7)).all()
    held = scored[scored.held_out & scored.quality.notna()]
    assert (held.predicted == held.quality).mean() > 0.93
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() > 0.96


def test_quality_ignores_held_out_labels(spark, folder):
    """Turning the held-out labels around changes no score."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    base = folder(documents=docs.withColumn("source", F.lit("s")).withColumn("lang", F.lit(None).cast("string")), labels=turned)
    a = {r.doc_id: r.score for r in QUERIES["op1_bradley_terry"](spark, SF).collect()}
    b = {r.doc_id: r.score for r in QUERIES["op1_bradley_terry"](spark, base).collect()}
    assert a == b


def test_quality_odd_rows(spark, documents, odd_rows):
    df = documents(odd_rows)
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.train(df, empty) is None
    one_kind = spark.createDataFrame([(4, 1), (5, 1), (None, 0), (6, None)], "doc_id bigint, quality int")
    assert quality.train(df, one_kind) is None
    assert {r[0] for r in df.select(quality.score(df["text"], None)).collect()} == {1.0}
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (6, 1), (6, 0), (13, 0), (99, 1), (1, 1)], "doc_id bigint, quality int")
    model = quality.train(df, labels)
    got = df.select("doc_id", "text", quality.score(df["text"], model).alias("s")).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.s <= 1 for r in got)
    assert len({r.s for r in got if not r.text}) == 1  # null and empty are alike
    assert documents([]).select(quality.score(F.col("text"), model)).count() == 0


def test_cut_is_a_quantile():
    rng = np.random.default_rng(1)
    better = np.arange(200) < 150
    x = rng.normal(better[:, None] * 4.0, 1, (200, quality.WIDTH)).astype(np.float32)
    model = quality.fit(x, better, 0.25)
    score = model.scores(x)
    assert abs((score < quality.CUT).mean() - 0.25) < 0.02
    assert np.array_equal(np.argsort(score[score < 1]), np.argsort((x @ model.weights)[score < 1]))


# -- language -----------------------------------------------------------------

def test_language_held_out(spark):
    got = QUERIES["op4_language"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98
    accepted = held[held.accepted]
    assert len(accepted) > 0.9 * len(held) and (accepted.lang_pred == accepted.lang).mean() > 0.99


def test_language_odd_rows(spark, odd_rows):
    rows = [(i, t, "en" if k % 2 else "fr") for k, (i, t) in enumerate(odd_rows)]
    df = spark.createDataFrame(rows + [(30, "123 !? 12½", "en"), (31, "ab", None)], "doc_id bigint, text string, lang string")
    model = language.train(df)
    for m in (model, None):
        got = df.select("text", language.predict(df["text"], m).alias("r")).select("text", "r.*").collect()
        for r in got:
            some = any(c.isalpha() for c in r.text or "") and m is not None
            assert (r.lang == "und") == (not some) and 0 <= r.score <= 1 and (some or r.score == 0)
    assert language.train(df.where("lang is null")) is None
    assert language.train(df.limit(0)) is None


def test_language_slices_alike():
    texts = ["der die das und", "the of and a", None, "", "İstanbul ÀÉ", "x" * 3000] * 3
    bucket, owner, some = language.grams([t or "" for t in texts])
    for i, t in enumerate(texts):
        b, _, s = language.grams([t or ""])
        assert sorted(bucket[owner == i]) == sorted(b) and some[i] == s[0]


# -- licences -----------------------------------------------------------------

def test_licences(spark, documents):
    mit = licenses.TEXTS["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("sublicense", "sub-license") + "\n"), (3, mit + " and more"),
            (4, "text\nReleased under the MIT Licence!\nmore\n  licensed under CC BY-NC 4.0"), (5, None), (6, ""), (7, "(c) me"),
            (8, "© x\nThis work is licensed under the GNU General Public License, version 3."), (None, mit), (9, "# SPDX-License-Identifier: Apache-2.0"),
            (4, "Licensed under the Apache License, Version 2.0."), (10, "word " * 50_000 + "\nReleased under the MIT License.")]
    got = licenses.license_scan(documents(rows), licenses.known_licences(spark))
    found = {(r.doc_id, r.text_license, r.line_licenses, r.n_license_lines) for r in got.collect()}
    assert got.count() == len(rows)
    assert {(1, "MIT", "", 0), (2, "MIT", "", 0), (3, None, "", 0), (5, None, "", 0), (6, None, "", 0), (7, None, "", 0), (8, "GPL-3.0", "GPL-3.0", 1),
            (None, "MIT", "", 0), (9, "Apache-2.0", "Apache-2.0", 1), (4, None, "Apache-2.0,CC-BY-NC-4.0,MIT", 3),
            (4, "Apache-2.0", "Apache-2.0,CC-BY-NC-4.0,MIT", 3), (10, None, "MIT", 1)} == found
    assert licenses.license_scan(documents([]), licenses.known_licences(spark)).count() == 0
    none = spark.createDataFrame([], "license string, text string")
    assert {r.text_license for r in licenses.license_scan(documents(rows), none).collect()} == {None}


def test_whole_licences(spark, documents):
    texts = licenses.whole_texts() + list(licenses.TEXTS.items())
    assert len({t for t, _ in texts}) == 15 and {t for t, _ in texts} <= set(licenses.NAMES)
    rows = [(i, "(c) 2021 Someone\n" + text.upper() + "\n") for i, (_, text) in enumerate(texts)]
    got = {r.doc_id: r.text_license for r in licenses.license_scan(documents(rows), licenses.known_licences(spark)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(texts)}


def wrapped(text, width, prefix=""):
    """Paragraphs filled anew; those with a copyright statement line by line, the statement itself as it is."""
    out = []
    for paragraph in re.split(r"\n\s*\n", text):
        lines = paragraph.split("\n")
        statement = [bool(re.match(r"\W*(copyright|©|\(c\))\W*(\(c\)|©|\d{4}|[<\[{])", line.lower())) for line in lines]
        if not any(statement):
            lines, statement = [" ".join(lines)], [False]
        for line, whole in zip(lines, statement):
            out += [line] if whole else textwrap.wrap(line, width, break_long_words=False, break_on_hyphens=False) or [""]
        out.append("")
    return "\n".join((prefix + line).rstrip() for line in out)


def test_licences_in_any_wrapping(spark, documents):
    texts = licenses.whole_texts() + list(licenses.TEXTS.items())
    rows, expected = [], {}
    for licence, text in texts:
        name = licenses.NAMES[licence][0].removeprefix("the ")
        heads = ["", "Copyright (c) 2021 Some Body\n\n", "Copyright 2019-2021 Some Body\nAll rights reserved.\n\n", f"{name}\n\n© Some Body\n\n",
                 f"{name.upper()} ({licence})\n\nCopyright (c) 2020, Some Body. All rights reserved.\n\n"]
        for width in (60, 72, 80, 100):
            for head in heads:
                for prefix in ("", "# ", " * "):
                    body = wrapped(head + text, width, prefix)
                    rows.append((len(rows), body))
                    expected[len(rows) - 1] = licence
    got = {r.doc_id: r.text_license for r in licenses.license_scan(documents(rows), licenses.known_licences(spark)).collect()}
    missed = {(expected[k], rows[k][1][:60]) for k in expected if got[k] != expected[k]}
    assert not missed, sorted(missed)[:10]


def test_titles_alone_and_bodies_that_look_like_statements(spark, documents):
    mit = licenses.TEXTS["MIT"]
    rows = [(1, "MIT License"), (2, "ISC License\n" + mit), (3, mit + "\n(c) the end"), (4, mit + "\ncopyright owners beware"), (5, mit + "\n(c) 2020 x"), (6, "All rights reserved.\n" + mit)]
    got = {r.doc_id: r.text_license for r in licenses.license_scan(documents(rows), licenses.known_licences(spark)).collect()}
    assert got == {1: None, 2: "MIT", 3: None, 4: None, 5: "MIT", 6: "MIT"}


def test_licences_stay_native(spark):
    plan = QUERIES["op3_license_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# -- decontamination ----------------------------------------------------------

def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


BENCH = [(1, "What colour has the clear sky above the hills at noon in the long dry summer? It is deep blue then."),
         (2, "Name the river that runs through the old town near the great northern forest and the lake.\nThe answer is Silver Brook."),
         (3, "short one"), (4, None), (5, "!!!"), (6, " ".join(f"term{i}" for i in range(90)) + ". The end of it.")]


def test_leaks(spark, documents):
    filler = " ".join(f"filler{i % 37} word{i % 11}" for i in range(300))
    q1, q2, q6 = BENCH[0][1], BENCH[1][1], BENCH[5][1]
    rows = [(1, filler + " " + q1 + " " + filler), (2, q1.upper()), (3, filler), (4, "What colour has the clear sky above the hills?"), (5, None), (6, ""),
            (7, q2.replace("\n", "   ")), (8, filler + " " + q6 + q1), (9, q1.split("?")[0] + "? " + filler), (None, q1), (10, "a short one here"),
            (2, q1), (11, " ".join(filler for _ in range(50)) + q2), (12, q1.replace("noon", "night"))]
    got = decontaminate.find_leaks(documents(rows), items(spark, BENCH))
    found = sorted(((r.doc_id, r.item_id) for r in got.collect()), key=repr)
    assert found == sorted([(1, 1), (2, 1), (2, 1), (7, 2), (8, 6), (8, 1), (None, 1), (10, 3), (11, 2)], key=repr)
    df = documents(rows)
    per_row = df.select(decontaminate.leaked_items(df["text"], items(spark, BENCH)).alias("x")).collect()
    assert sorted(len(r.x) for r in per_row) == [0, 0, 0, 0, 0, 0, *[1] * 7, 2]


def test_leaks_by_shard_and_empty_tables(spark, documents, monkeypatch):
    df = documents([(1, BENCH[0][1]), (2, BENCH[1][1]), (3, "nothing")])
    want = [(1, 1), (2, 2)]
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 60)
    assert len(decontaminate.shards(items(spark, BENCH))) > 3
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, items(spark, BENCH)).collect()) == want
    none = items(spark, BENCH).limit(0)
    assert decontaminate.find_leaks(df, none).count() == 0
    assert df.where(F.size(decontaminate.leaked_items(df["text"], none)) == 0).count() == 3
    assert decontaminate.find_leaks(documents([]), items(spark, BENCH)).count() == 0


def test_search_is_exhaustive(spark):
    """Block-max WAND retrieves what scoring every item retrieves."""
    index = decontaminate.Index([(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    texts = pa.array([r.text for r in table(spark, SF, "documents").limit(30).collect()])
    (raw, offsets), = slices(decontaminate.lower(texts), 1 << 60)
    word, _ = decontaminate.words(raw, offsets)
    rng, hits = np.random.default_rng(0), 0
    for k in range(400):
        a = rng.integers(0, len(word) - 64)
        parts = [word[a:a + 64]] if k % 2 else [word[a:a + 20], index.words[rng.integers(len(index.ids))][:40]]
        terms = np.unique(index.terms(np.concatenate(parts)))
        terms = terms[terms >= 0].tolist()
        score = np.zeros(len(index.ids))
        for t in terms:
            score[index.postings[t]] += index.impacts[t]
        want = {int(i): float(score[i]) for i in np.flatnonzero(score >= 1 - 1e-9)}
        assert dict(index.search(terms)) == pytest.approx(want)
        hits += len(want)
    assert hits > 50


def test_all_verbatim_leaks_are_found(spark):
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    bench = [(r.item_id, norm(r.text)) for r in table(spark, SF, "benchmark").collect()]
    want = {(r.doc_id, i) for r in table(spark, SF, "documents").collect() for i, t in bench if t in norm(r.text)}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op7_bm25_leaks"](spark, SF).collect()} == want and len(want) > 20


def test_utf8_of_slices():
    x = pa.array(["a", None, "é", "", "abc"])
    raw, offsets = utf8(x.slice(1, 4))
    assert raw.tobytes().decode() == "éabc" and offsets.tolist() == [0, 0, 2, 2, 5]
    assert [o.tolist() for _, o in slices(x, 2)] == [[0, 1, 1], [0, 2, 2], [0, 3]]
    assert list(slices(pa.array([], pa.string()))) == []


def test_quality_counts_every_label(spark):
    """The share of worse labels is met to the row over more labels than a sample of 3,000 held,
    and the model doesn't depend on how the rows are dealt."""
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abcdef ."), 30)) for _ in range(5000)]
    better = rng.random(5000) < np.array([0.2 + 0.02 * t.count("a") for t in texts])
    docs = spark.createDataFrame(list(zip(range(5000), texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(b)) for i, b in enumerate(better)], "doc_id bigint, quality int")
    model = quality.train(docs.repartition(3), labels)
    assert (model.scores(quality.features(*utf8(pa.array(texts)))) < quality.CUT).sum() == (~better).sum()
    again = quality.train(docs.repartition(7), labels.repartition(2))
    assert (model.weights == again.weights).all() and model.cut == again.cut
    local = quality.fit(quality.features(*utf8(pa.array(texts))), better, (~better).mean())
    assert (model.weights == local.weights).all() and model.cut == local.cut


def test_quality_fit_is_of_all_pairs():
    """The gradient at the end of the fit, over written-out pairs, is near zero."""
    rng = np.random.default_rng(9)
    better = rng.random(300) < 0.4
    x = rng.normal(better[:, None] * np.array([1.0, -0.5, 0, 0]), 1, (300, 4)).astype(np.float32)
    model = quality.fit(x, better, (~better).mean())
    w, spread = model.weights * (x.std(0) + 1e-3), x.std(0) + 1e-3
    d = ((x[better][:, None] - x[~better][None]) / spread).reshape(-1, 4)
    assert np.abs(((1 / (1 + np.exp(d @ w)))[:, None] * d).mean(0) - quality.RIDGE * w).max() < 0.01


def test_quality_vectors_read_back():
    texts = pa.array(["", "a", "e " * 3000, None, "Zürich\n", "x" * 255, "x" * 256])
    assert (quality.unpacked(quality.packed(*utf8(texts))) == quality.features(*utf8(texts))).all()
