"""Pieces, byte-level BPE and the id files against the libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citeweave.llm import rans
from citeweave.llm.byte_bpe import Bpe, byte_bpe, read_ranks
from citeweave.llm.common import slices
from citeweave.llm.words import Known, encode, pieces

PIECES = regex.compile(P.PATTERN)
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "b", "s", "t", "re", "ve", "ll", "m", "d", "'", "'s", " ", "  ", "\n", "\t", "\r\n", "1", "²", "é", "漢", "!", " ", "　", "\x1c", "_", "𝔘", "é", "\x00"]


def cut(texts):
    out = []
    for raw, offsets in slices(pa.array(texts), 3000):
        text, points, starts, owner = pieces(raw, offsets)
        ends = np.append(starts[1:], len(points))
        own = [[] for _ in range(len(offsets) - 1)]
        for a, b, k in zip(starts.tolist(), ends.tolist(), owner.tolist()):
            own[k].append(text[a:b])
        out += own
    return out


def test_pieces_are_the_patterns_matches():
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(14))) for _ in range(20_000)]
    assert cut(texts) == [PIECES.findall(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_pieces_of_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    # runs of letters, numbers and spaces depend on the libraries' Unicode versions alone
    assert cut(texts) == [PIECES.findall(t) for t in texts]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query(spark, documents, odd_rows, library):
    long = "".join(chr(97 + i * i % 7) for i in range(700))  # many rounds for one word
    rows = odd_rows + [(50, long), (51, " " * 100 + "a" * 90), (52, "\x00\x01")]
    df = documents(rows)
    got = df.select("doc_id", "text", byte_bpe(df["text"], RANKS).alias("out")).select("text", "out.*").collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert documents([]).select(byte_bpe(F.col("text"), RANKS)).count() == 0


def test_bpe_forgets_and_goes_on(library):
    bpe = Bpe(read_ranks(RANKS))
    bpe.known = Known(most=20)
    texts = [" ".join(f"word{i} {'z' * (i % 9)}é" for i in range(k, k + 15)) for k in range(0, 60, 3)]
    for raw, offsets in slices(pa.array(texts), 300):
        ids, counts = bpe.encode(raw, offsets)
        assert b"".join(bpe.decode(ids, counts)) == raw.tobytes()
        assert ids.tolist() == [x for t in (raw[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])) for x in library.encode_ordinary(t)]


def test_leftmost_pair_of_least_rank():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258}
    bpe = Bpe(ranks)
    ids = [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_words(["aaaa", "aaaaa", "baa", "aaab"])]
    assert ids == [[256, 256], [256, 257], [98, 256], [257, 98]]


def test_long_pieces_and_texts(library):
    bpe = Bpe(read_ranks(RANKS))
    mixed = "".join(chr(97 + i * i % 23) for i in range(30_000))
    for text in ("a" * 1_000_000, " " * 400_000 + "=" * 400_000, "é" * 50_000 + mixed):
        raw, offsets = next(slices(pa.array([text])))
        ids, counts = bpe.encode(raw, offsets)
        assert np.concatenate([[0], np.cumsum(counts)]).tolist() == [0, len(ids)]
        assert bpe.decode(ids, counts) == [text.encode()]
        if text[0] == "é":
            assert ids.tolist() == library.encode_ordinary(text)
    words = [mixed[a:a + n] for a in range(0, 300, 30) for n in (2, 3, 40, 300)]
    assert [bpe._merge_long(w.encode()) for w in words] == bpe._merge([w.encode() for w in words])
    raw, offsets = next(slices(pa.array(["a b c d e f g h i j " * 300_000])))
    ids, counts = bpe.encode(raw, offsets)
    assert bpe.decode(ids, counts) == [raw.tobytes()]


def test_long_words_merge_leftmost_pair_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258, b"ab": 259, b"aba": 255 + 5, b"bab": 261}
    bpe = Bpe(ranks)
    words = ["".join("ab"[i * k % 7 < 4] for i in range(n)).encode() for k in range(1, 7) for n in (2, 5, 17, 40)]
    assert [bpe._merge_long(w) for w in words] == bpe._merge(words)


# -- id files -----------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 5, 31, 32, 33, 8192, 8193, 32768, 32769, 100_000])
def test_group_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.3, n).astype(np.uint64) % 50_257
    counts = np.array([n // 3, 0, n - n // 3])
    doc_ids, back, got = rans.unpack(rans.pack([-5, None, 2**62], counts, ids.astype(np.uint32)))
    assert doc_ids == [-5, None, 2**62] and back.tolist() == counts.tolist() and np.array_equal(got, ids)


def test_group_of_one_symbol_and_of_all():
    for ids in (np.full(70_000, 7, np.uint32), np.arange(60_000, dtype=np.uint32)):
        assert np.array_equal(rans.unpack(rans.pack([1], np.array([len(ids)]), ids))[2], ids)


def test_damage_is_found():
    data = bytearray(rans.pack([1], np.array([50_000]), np.random.default_rng(1).integers(0, 999, 50_000).astype(np.uint32)))
    data[-100] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        rans.unpack(bytes(data))
    with pytest.raises(ValueError, match="format"):
        rans.unpack(b"nope" + bytes(data[4:]))


def test_frequencies_add_up():
    for counts in ([1], [5, 0, 3], [10**9] + [1] * 1000, [1] * 50_257):
        ids = np.repeat(np.arange(len(counts)), np.minimum(counts, 5000))
        f = rans.frequencies(ids)
        assert f.sum() == 1 << rans.BITS and ((f > 0) == (np.array(counts) > 0)).all()


def expected(rows, end_id=2):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    out, start = [], 0
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_id_files(documents, odd_rows, monkeypatch):
    rows = odd_rows + [(1000 + i, f"text {i} " * (i % 50)) for i in range(200)]
    got = rans.coded_ids(documents(rows), P.path("byte_bpe_50k.json"), 2).select("doc_id", "start", "n_tokens", F.crc32("ids"))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_id_files_of_an_empty_table(documents):
    assert rans.coded_ids(documents([]), P.path("byte_bpe_50k.json"), 2).count() == 0


def test_pieces_encoded_together_as_alone():
    encoder = rans.JsonEncoder(P.path("byte_bpe_50k.json"))
    words = ["'s", "abc", " abc", "\n", "  ", " é", "!?", " '", "1", "　", "x" * 300, " \t", "'", "<|", "|>"]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_words(words)]
    assert got == [encoder.library.encode(w, add_special_tokens=False).ids for w in words]


def test_known_pieces():
    known = Known(most=10)
    seen = []

    def words(fresh):
        seen.append(len(fresh))
        return [np.arange(len(w), dtype="<u4").tobytes() for w in fresh]

    for text in ("aa bb aa", "aa bb", "cc dd ee ff gg hh ii", "aa"):
        (raw, offsets), = slices(pa.array([text]))
        ids, counts = encode(raw, offsets, known, words)
        assert ids.tolist() == [k for w in PIECES.findall(text) for k in range(len(w))] and counts.tolist() == [len(ids)]
    assert seen[0] == 3 and len(known.keys) <= 10
