"""Exact, line and near deduplication and repeated strings against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeweave.llm import exact_dedup as exact, near_dedup as near, suffix_dedup as suffix
from citeweave.llm.components import components
from citeweave.llm.line_dedup import line_dedup

BLANKS = " \t\n\x0b\f\r"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- exact --------------------------------------------------------------------

def exact_by_hand(rows):
    plain = [(i, len(t or ""), "".join(c for c in t or "" if c not in BLANKS)) for i, t in rows]
    groups = defaultdict(list)
    for i, n, p in plain:
        groups[p].append((-n, i is None, i or 0, i))
    out = []
    for i, n, p in plain:
        keep = min(groups[p], key=lambda x: x[:3])[3]
        out.append((i, keep, len(groups[p]), i == keep, hashlib.sha256(p.encode()).hexdigest(), n))
    return sorted(out, key=repr)


def test_exact(documents, odd_rows):
    assert rows_of(exact.exact_dedup(documents(odd_rows))) == exact_by_hand(odd_rows)


def test_exact_verifies_identifiers(documents):
    """With 8-bit identifiers contents collide: other seeds are tried until none do."""
    ids = defaultdict(list)
    for i in range(400):
        ids[exact.chunk_id(f"text{i}".encode(), 0, 1)].append(i)
    a, b = next(x for x in ids.values() if len(x) > 1)[:2]
    rows = [(i, f"text {(a, b, *range(1000, 1008))[i % 10]}") for i in range(40)]
    df = documents(rows)
    assert exact.verified_seed(df, 1) > 0
    assert rows_of(exact.exact_dedup(df, 1)) == exact_by_hand(rows)
    with pytest.raises(RuntimeError):
        exact.verified_seed(documents([(i, f"t{i}") for i in range(300)]), 1, tries=2)


def test_chunks_follow_content():
    data = np.random.default_rng(1).integers(0, 256, 200_000, np.uint8).tobytes()
    a, b = exact.chunks(data), exact.chunks(b"a prefix of other bytes" + data)
    assert b"".join(a) == data and all(len(c) <= exact.CHUNK_MOST for c in a)
    assert len(set(a) & set(b)) > len(a) * 0.8
    assert exact.chunks(b"") == [b""] and len(exact.chunks(b"a" * 100_000)) == -(-100_000 // exact.CHUNK_MOST)


def test_exact_empty_table(documents):
    assert exact.exact_dedup(documents([])).count() == 0


# -- lines --------------------------------------------------------------------

def lines_by_hand(rows, least_docs=2):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(BLANKS).translate(table)
    where = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 10:
                    where[key(x)].add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        rest = [x for x in own if i is None or len(where.get(key(x), ())) < least_docs or min(where[key(x)]) == i]
        out.append((i, "\n".join(rest), len(own), len(own) - len(rest)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_docs", [2, 3])
def test_lines(documents, odd_rows, least_docs):
    rows = odd_rows + [(20, "THE SAME LINE HERE\nshort\nshort"), (21, "short\n\t the same line here"), (22, "ÉTÉ ÉTÉ ÉTÉ\nété été été")]
    out = line_dedup(documents(rows), min_docs=least_docs)
    assert rows_of(out.select("doc_id", "line_dedup.*")) == lines_by_hand(rows, least_docs)
    assert "label" in out.columns


def test_lines_empty_table(documents):
    assert line_dedup(documents([])).count() == 0


# -- near ---------------------------------------------------------------------

def sets_by_hand(rows, width):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    return out


def near_by_hand(rows, width, similarity=80):
    sets = sets_by_hand(rows, width)
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, _) in enumerate(rows):
        for m in range(k):
            j = rows[m][0]
            both = len(sets[k] & sets[m])
            if None not in (i, j) and both and 100 * both >= similarity * len(sets[k] | sets[m]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return sorted(((i, len(s), None if i is None else top(i), i is None or top(i) == i) for (i, _), s in zip(rows, sets)), key=repr)


def family(n, words, changes, seed):
    r = random.Random(seed)
    base = [f"v{r.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randrange(changes)):
            own[r.randrange(words)] = f"n{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_near(documents, odd_rows, width):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(family(40, 60, 9, 1) + family(25, 200, 30, 2) + ["a b", "b a", "A b"])]
    assert rows_of(near.near_dedup(documents(rows), width=width)) == near_by_hand(rows, width)


def test_near_group_in_blocks(documents, monkeypatch):
    """A group beyond the bound is compared block by block, with equal results."""
    monkeypatch.setattr(near, "GROUP_SHINGLES", 300)
    rows = [(i, t) for i, t in enumerate(family(60, 60, 12, 3))]
    assert rows_of(near.near_dedup(documents(rows), width=2)) == near_by_hand(rows, 2)


def test_near_empty_table(documents):
    assert near.near_dedup(documents([])).count() == 0


def test_linked_is_all_pairs():
    r = random.Random(5)
    for _ in range(50):
        base = r.sample(range(100), 40)
        sets = [np.array(sorted(set(base[:r.randrange(20, 40)] + r.sample(range(100), r.randrange(8)))), np.uint64) for _ in range(25)]
        want = np.arange(25)
        for i in range(25):
            for j in range(25):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((want[i], want[j]))
                    want[want == b] = a
        assert near.linked(sets, 80).tolist() == want.tolist()


def test_tensored_keys_find_similar_sets():
    """Pairs at the threshold share a key; unlike ones hardly do."""
    rng = np.random.default_rng(1)
    hit = {0.8: 0, 0.2: 0}
    for share in hit:
        for _ in range(300):
            both = rng.integers(0, 2**63, int(200 * share)).astype(np.uint64)
            one, two = (rng.integers(0, 2**63, (200 - len(both)) // 2).astype(np.uint64) for _ in range(2))
            keys = near.table_keys(near.signatures([np.unique(np.concatenate([both, x])) for x in (one, two)]))
            assert keys.shape[1] == near.SIDE ** 2
            hit[share] += bool(set(keys[0].tolist()) & set(keys[1].tolist()))
    assert hit[0.8] >= 299 and hit[0.2] < 150


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {x.node: x.label for x in got.collect()} == {x: top(x) for x in up}


# -- repeated strings ---------------------------------------------------------

def strings_by_hand(rows, n=50):
    first = {}
    for i, t in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            first.setdefault(b[k:k + n], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if i is not None and first[b[k:k + n]] < i:
                gone[k:k + n] = b"\1" * n
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, bytes(c for c, g in zip(b, gone) if not g), len(b), sum(gone), runs))
    return sorted(out, key=repr)


def got_strings(df):
    rows = suffix.suffix_dedup(df, out="r").select("doc_id", "r.*").collect()
    return sorted(((x[0], bytes(x[1]), *x[2:]) for x in rows), key=repr)


def test_strings(documents, odd_rows, monkeypatch):
    rows = [x for x in odd_rows if len(x[1] or "") < 10_000]
    r = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    passage = " ".join(r.choice(words) for _ in range(60))
    for i in range(30):
        a, b = r.randrange(len(passage) // 2), r.randrange(len(passage) // 2, len(passage))
        rows.append((200 + i, " ".join(r.choice(words) for _ in range(20)) + passage[a:b] + " ".join(r.choice(words) for _ in range(r.randrange(30)))))
    rows += [(300, "ab" * 400), (301, "ab" * 500 + "c"), (302, "ab" * 24 + "a"), (303, "ab" * 25), (304, passage + passage), (305, passage[:49]), (306, passage[:50]),
             (307, "é" * 80), (308, "x" + "é" * 60)]
    want = strings_by_hand(rows)
    assert got_strings(documents(rows)) == want
    monkeypatch.setattr(suffix, "MOST_WINDOWS", 7)
    monkeypatch.setattr(suffix, "SORT_BYTES", 100)
    assert got_strings(documents(rows)) == want


def test_strings_of_a_crowded_minimizer(documents, monkeypatch):
    """Both ends of a passage give each document a segment of its own: no task sorts them all."""
    r = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    other = [" ".join(str(r.randrange(10**6)) for _ in range(12)) for _ in range(100)]
    rows = [(i, r.choice(other)[r.randrange(30):] + passage + r.choice(other)[:r.randrange(20, 60)]) for i in range(150)]
    rows += [(7, "x" + passage), (400, passage + "," + passage), (401, "ab" * 400), (402, "ab" * 500 + "c")]
    want = strings_by_hand(rows)

    def checked(segments, owner, limit=2500, sort=suffix.repeated_windows):
        assert sum(map(len, segments)) <= limit
        return sort(segments, owner)

    monkeypatch.setattr(suffix, "SORT_BYTES", 100)
    monkeypatch.setattr(suffix, "RUN_BYTES", 2000, raising=False)
    monkeypatch.setattr(suffix, "repeated_windows", checked)
    assert got_strings(documents(rows)) == want


def seeds_only(n):
    """Texts that share 36-byte strings, and no 50-byte string."""
    r = random.Random(6)
    common = ["".join(r.choice("abcdefgh ") for _ in range(36)) for _ in range(8)]
    return ["".join(r.choice(common) + f"<{i}.{k}>" for k in range(20)) for i in range(n)]


def test_strings_of_shared_seeds_are_not_sorted(documents, monkeypatch):
    """A minimizer that many documents have in other surroundings gives the suffix array nothing to do."""
    texts = seeds_only(200)
    rows = list(enumerate(texts)) + [(500, texts[3][100:400]), (501, "x" + texts[3][100:400] + "y")]
    want = strings_by_hand(rows)
    assert sum(x[3] for x in want) >= 600

    def checked(segments, owner, limit=5000, sort=suffix.repeated_windows):
        assert sum(map(len, segments)) <= limit
        return sort(segments, owner)

    monkeypatch.setattr(suffix, "repeated_windows", checked)
    assert got_strings(documents(rows)) == want


def test_minimizers_fill_buckets_evenly(documents):
    """No task has much more than its share of the minimizers, however many buckets there are."""
    seen = []

    class Texts:
        def select(self, *columns):
            return self

        def mapInArrow(self, f, schema):
            seen.append(f)
            return self

        repartition = sortWithinPartitions = select

    suffix.shared_minimizers(Texts(), 6)
    r = random.Random(7)
    texts = pa.array(["".join(r.choice("abcdefghijklmnop ") for _ in range(4000)) for _ in range(50)])
    size = Counter()
    for batch in seen[0]([pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), texts], ["doc_id", "text"])]):
        for bucket, docs in zip(batch.column("bucket").to_pylist(), batch.column("docs").to_pylist()):
            size[bucket] += len(docs) // 8
    assert len(size) == 64 and max(size.values()) < 2 * sum(size.values()) / 64


@pytest.mark.parametrize("limits", [(1, 10**6, 10**6, 1), (300, 2500, 150, 100), (10**6, 10**6, 0, 10**6)])
def test_strings_under_any_limits(documents, odd_rows, monkeypatch, limits):
    """Rows gathered in small lots, minimizers and pieces beyond the bounds: equal results."""
    for name, value in zip(("GATHERED_BYTES", "HELD_BYTES", "RUN_BYTES", "SORT_BYTES"), limits):
        monkeypatch.setattr(suffix, name, value)
    r = random.Random(8)
    texts = seeds_only(40)
    rows = [x for x in odd_rows if len(x[1] or "") < 10_000] + list(enumerate(texts, 100))
    for i in range(60):
        a = r.randrange(300)
        rows.append((200 + i // 2, str(r.random()) * r.randrange(3) + texts[i % 7][a:a + r.randrange(40, 250)] + r.choice(["", "tail", texts[i % 5][:90]])))
    rows += [(-3, texts[39]), (400, "ab" * 600), (401, "ab" * 700 + "c"), (402, texts[5] + texts[5])]
    assert got_strings(documents(rows)) == strings_by_hand(rows)


def test_repeated_spans_by_hand():
    r = random.Random(9)
    for _ in range(60):
        base = "".join(r.choice("ab") for _ in range(130)).encode()
        rows = set()
        for doc in range(r.randrange(2, 12)):
            for _ in range(r.randrange(1, 4)):
                a = r.randrange(70)
                x = base[a:a + r.randrange(50, 100)]
                rows.add((x if len(x) >= 50 else base, doc))
        first = {x: min(d for y, d in rows if y == x) for x, _ in rows}
        rows = sorted((x, d) for x, d in rows if first[x] == d for _ in range(r.randrange(1, 3)))
        owner = {}
        for x, d in rows:
            for k in range(len(x) - 49):
                owner[x[k:k + 50]] = min(d, owner.get(x[k:k + 50], d))
        want = {(i, k) for i, (x, d) in enumerate(rows) for k in range(len(x) - 49) if owner[x[k:k + 50]] < d}
        for run_bytes in (10**6, 0):
            spans = list(zip(*suffix.repeated_spans(np.ones(len(rows), np.int64), pa.array([x for x, _ in rows], pa.binary()), np.array([d for _, d in rows]), run_bytes=run_bytes)))
            got = {(i, k) for i, a, n, piece in spans if piece is None for k in range(a, a + n - 49)}
            left = {(i, k) for i, a, n, piece in spans if piece is not None for k in range(a, a + n - 49)}
            assert all(rows[i][0][a:a + n] == piece for i, a, n, piece in spans if piece is not None)
            assert got == want if run_bytes else got <= want <= got | left


def test_strings_empty_table(documents):
    assert got_strings(documents([])) == []


def test_suffix_array():
    r = random.Random(3)
    for _ in range(400):
        s = np.array([r.randint(1, r.choice([1, 2, 3, 9, 10**7])) for _ in range(r.randint(1, 60))], np.int64)
        assert suffix.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_long_text_strings(documents):
    text = " ".join(f"w{i * i % 9973}" for i in range(20_000))
    rows = [(1, text), (2, "other " + text[1000:90_000])]
    assert got_strings(documents(rows)) == strings_by_hand(rows)


def test_counts_are_stable_under_layout(documents, odd_rows):
    df = documents([x for x in odd_rows if len(x[1] or "") < 10_000])
    assert got_strings(df) == got_strings(df.repartition(7).orderBy(F.rand(3)))
    assert Counter(rows_of(exact.exact_dedup(df))) == Counter(rows_of(exact.exact_dedup(df.repartition(7))))
