"""Two tokenizers aligned, against the libraries on whole texts and plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from citeweave.llm import alignment
from citeweave.llm.queries import QUERIES
from conftest import SF

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    decoded = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    decoded |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if chr(b) not in decoded)}
    names = {i: t for t, i in a.get_vocab().items()}
    return a, lambda i: bytes(decoded[c] for c in names[i]), sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def brute(rows, libraries):
    """The answer for rows of (doc_id, text), each text encoded whole and every token pair tried."""
    a, a_bytes, b = libraries
    found, held = [], defaultdict(int)
    for doc_id, text in rows:
        one = dict(doc_id=doc_id, n_a=0, n_b=0, n_groups=0, n_links=0, groups="", pairs=Counter())
        found.append(one)
        if not text:
            continue
        whole = (" " + text).encode()
        x = [(i, a_bytes(i)) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
            continue

        def ranges(tokens):
            at = 0
            for i, t in tokens:
                yield i, at, at + len(t)
                at += len(t)

        x, y = list(ranges(x)), list(ranges(y))
        cuts = {e for _, _, e in x} & {e for _, _, e in y}

        def split(tokens):
            out = [[]]
            for i, _, e in tokens:
                out[-1].append(str(i))
                if e in cuts:
                    out.append([])
            return out[:-1]

        one["groups"] = ";".join(",".join(i) + "|" + ",".join(j) for i, j in zip(split(x), split(y)))
        k = 0
        for i, s, e in x:
            while k and y[k - 1][2] > s:
                k -= 1
            while y[k][2] <= s:
                k += 1
            m = k
            while m < len(y) and y[m][1] < e:
                one["pairs"][i, y[m][0]] += 1
                m += 1
        one |= dict(n_a=len(x), n_b=len(y), n_groups=len(cuts), n_links=sum(one["pairs"].values()))
        for pair in one["pairs"]:
            held[pair] += 1
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for one in found:
        pairs = one.pop("pairs")
        one["n_best"] = sum(n for p, n in pairs.items() if held[p] == most[p[0]])
        one["count_sum"] = sum(n * held[p] for p, n in pairs.items())
        one["groups_sha256"] = hashlib.sha256(one["groups"].encode()).hexdigest() if one["n_a"] else ""
        out.append(one)
    return out, dict(held)


def in_order(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_a"], r["groups_sha256"], r["count_sum"]))


ODD = ["▁a", "a▁ b", " lead", "trail ", "a  b   c", "\ta\n b \n  c\n\n", "x y  z", "don't  can't", "<|endoftext|> <s>a</s> <0x41>", "漢字 かな", "𝔘 é é ﬁ ½", "a\x00b", "\x85 a\x85 b",
       " ", "  ", "\n", "==== " * 50, "=" * 3000, "ab" * 2000, "word " * 3000, "１２３ 456,789.0", "​ ​﻿", "the the the cat", "The cat. The  cat."]


def test_equal_to_the_libraries(documents, odd_rows, libraries):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    expected, held = brute(rows, libraries)
    found, counts = alignment.align(documents(rows), A_PATH, B_PATH, with_groups=True)
    assert in_order(r.asDict() for r in found.collect()) == in_order(expected)
    assert {(r.a, r.b): r.n_docs for r in counts.collect()} == held
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    assert all(r.best == (r.n_docs == most[r.a]) and r.n_links >= r.n_docs for r in counts.collect())


def test_query_equals_brute_force(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected, _ = brute(rows, libraries)
    for e in expected:
        del e["groups"]
    assert in_order(r.asDict() for r in QUERIES["op12_alignment"](spark, SF).collect()) == in_order(expected)


def test_empty_table(documents):
    found, counts = alignment.align(documents([]), A_PATH, B_PATH)
    assert found.collect() == [] and counts.collect() == []


def test_chunks_do_not_change_the_answer(spark, documents, libraries):
    """Chunks that are closed early and many partitions give the same counts."""
    rows = [(i, f"the cat {i % 7} sat on cat {i % 3} " * (1 + i % 5)) for i in range(60)]
    expected, held = brute(rows, libraries)
    found, counts = alignment.align(documents(rows).repartition(7), A_PATH, B_PATH, with_groups=True)
    assert in_order(r.asDict() for r in found.collect()) == in_order(expected)
    assert {(r.a, r.b): r.n_docs for r in counts.collect()} == held


def test_containers_both_ways():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(alignment.CHUNK, n, replace=False)) for n in (1, 5, 511, 512, 513, 4000, alignment.CHUNK)]
    key = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    first, n, bits = alignment.containers(key, np.concatenate(rows))
    assert n.tolist() == [len(r) for r in rows] and max(len(x.as_py()) for x in bits) == alignment.CHUNK // 8
    row, place = alignment.members(bits)
    for k, r in enumerate(rows):
        assert np.sort(place[row == k]).tolist() == r.tolist()


def test_links_are_overlaps():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 30))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, 8), n)) for _ in range(2))
        x, y = alignment.links(a, np.diff(a, prepend=0), b, np.diff(b, prepend=0))
        starts = [np.concatenate([[0], e[:-1]]) for e in (a, b)]
        assert sorted(zip(x.tolist(), y.tolist())) == [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
