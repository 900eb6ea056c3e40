"""Byte-level BPE by recursive queries, inside each task's DuckDB.

A slice of texts is cut into the pattern's pieces, and each distinct piece
that the worker has not met is encoded by a recursive query over token
positions: every round joins neighbouring tokens with the merge table and
contracts each word's leftmost pair of least rank, until no pair is left.
Decoding joins ids with the vocabulary and puts their bytes together by an
ordered aggregation.

The recursion keeps the rows of all its rounds, so a query starts from
QUERY_ROWS rows at most, runs ROUNDS rounds at most, and words that are not done
go into the next query. A round merges one pair of a word, so a word's work
grows with its length squared: words beyond LONG_WORD bytes are merged by a heap
of their pairs instead, in the same order. A text is decoded QUERY_ROWS ids at
once. So DuckDB's memory has a bound, however long the texts and pieces are.

Defined results: a null text counts as empty, and an empty text has no ids.
Special tokens in a text are ordinary text. Rows are independent: repeated
rows get the same answer, and other columns are not read.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.llm.common import slices
from citeweave.llm.words import Known, encode

ROUNDS = 32
#: Rows of token positions that one recursive query starts from.
QUERY_ROWS = 100_000
#: Bytes of the longest word that goes into a query.
LONG_WORD = 2_000

ENCODE = f"""
with recursive state(round, word, pos, tok) as (
  select 0, word, pos, tok from start
  union all
  select round, word, pos, tok from (
    with pairs as (
      select round, word, pos, tok, lead(tok) over w as right_tok, lag(pos) over w as left_pos
      from state window w as (partition by word order by pos)),
    ranked as (
      select pairs.*, merges.merged from pairs
      left join merges on merges.left_tok = pairs.tok and merges.right_tok = pairs.right_tok),
    least as (
      select word, min(merged::bigint * {1 << 40} + pos) as best from ranked
      where merged is not null and round < {ROUNDS} group by word)
    select round + 1 as round, word, pos, case when pos = best % {1 << 40} then merged else tok end as tok
    from ranked join least using (word)
    where left_pos is distinct from best % {1 << 40}))
select s.round, s.word, s.pos, s.tok from state s
join (select word, max(round) as round from state group by word) using (word, round)
order by s.word, s.pos
"""

DECODE = """
select owner, string_agg(vocab.latin, '' order by pos) as latin
from ids join vocab on vocab.id = ids.id group by owner order by owner
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file's tokens; each worker reads it from the installed package."""
    rows = (line.split() for line in open(path, "rb") if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in rows}


class Bpe:
    """The merge table and the vocabulary in a DuckDB of this process."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.ranks = ranks
        self.pairs = {}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        rows = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        merges = pa.table(dict(zip(("left_tok", "right_tok", "merged"), (pa.array(c, pa.int32()) for c in zip(*rows)))) if rows
                          else {c: pa.array([], pa.int32()) for c in ("left_tok", "right_tok", "merged")})
        vocab = pa.table({"id": pa.array(ranks.values(), pa.int32()), "latin": [t.decode("latin-1") for t in ranks]})
        self.merges = merges
        self.db.register("m", merges)
        self.db.execute("create table merges as select * from m")
        self.db.register("v", vocab)
        self.db.execute("create table vocab as select * from v")
        self.known = Known()

    def encode_words(self, words: list[str]) -> list[bytes]:
        data = [w.encode() for w in words]
        out: list[bytes | None] = [None if (r := self.ranks.get(d)) is None else np.array([r], "<u4").tobytes() for d in data]
        rest = sorted((i for i, x in enumerate(out) if x is None), key=lambda i: len(data[i]))
        while rest and len(data[rest[-1]]) > LONG_WORD:
            i = rest.pop()
            out[i] = self._merge_long(data[i])
        a = 0
        while a < len(rest):
            b, rows = a, 0
            while b < len(rest) and (b == a or rows + len(data[rest[b]]) <= QUERY_ROWS):
                rows += len(data[rest[b]])
                b += 1
            for i, ids in zip(rest[a:b], self._merge([data[i] for i in rest[a:b]])):
                out[i] = ids
            a = b
        return out

    def _merge(self, words: list[bytes]) -> list[bytes]:
        n = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), n)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
        tok = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        out: list[bytes] = [b""] * len(words)
        while len(word):
            self.db.register("start", pa.table({"word": word, "pos": pos, "tok": tok}))
            got = self.db.execute(ENCODE).fetchnumpy()
            self.db.unregister("start")
            word, pos, tok = got["word"], got["pos"], got["tok"].astype(np.int32)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            data = tok.astype("<u4").tobytes()
            done = got["round"] < ROUNDS
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(word)]):
                if done[a]:
                    out[word[a]] = data[4 * a:4 * b]
            word, pos, tok = word[~done], pos[~done], tok[~done]
        return out

    def _merge_long(self, word: bytes) -> bytes:
        """The ids of one long word: the leftmost pair of least rank is merged until none is left."""
        if not self.pairs:
            left, right, merged = (c.to_numpy().astype(np.int64) for c in self.merges.columns)
            self.pairs = dict(zip((left << 32 | right).tolist(), merged.tolist()))
        pairs, n = self.pairs, len(word)
        tok = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [merged << 40 | i for i in range(n - 1) if (merged := pairs.get(tok[i] << 32 | tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best = heapq.heappop(heap)
            merged, i = best >> 40, best & (1 << 40) - 1
            j = after[i]
            if tok[i] < 0 or j >= n or pairs.get(tok[i] << 32 | tok[j]) != merged:
                continue  # one of the two has gone into another token
            tok[i], tok[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(merged << 32 | tok[k])) is not None:
                    heapq.heappush(heap, r << 40 | i)
            h = before[i]
            if h >= 0 and (r := pairs.get(tok[h] << 32 | merged)) is not None:
                heapq.heappush(heap, r << 40 | h)
        return np.array([t for t in tok if t >= 0], "<u4").tobytes()

    def encode(self, raw, offsets):
        return encode(raw, offsets, self.known, self.encode_words)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text; counts are its numbers of ids."""
        owner = np.repeat(np.arange(len(counts)), counts)
        out = [[] for _ in counts]
        for a in range(0, len(ids), QUERY_ROWS):
            part = ids[a:a + QUERY_ROWS]
            self.db.register("ids", pa.table({"owner": owner[a:a + QUERY_ROWS], "pos": np.arange(len(part)), "id": part.astype(np.int32)}))
            got = self.db.sql(DECODE).to_arrow_table()
            self.db.unregister("ids")
            for i, text in zip(got["owner"].to_pylist(), got["latin"].to_pylist()):
                out[i].append(text.encode("latin-1"))
        return [b"".join(x) for x in out]


_BPES: dict[str, Bpe] = {}


def worker_bpe(path: str) -> Bpe:
    """The worker's tables and pieces; they outlive the task."""
    if path not in _BPES:
        _BPES[path] = Bpe(read_ranks(path))
    return _BPES[path]


def bpe_udf(path: str):
    """text -> struct<ids binary, decoded binary>: its ids as little-endian uint32 and their bytes."""
    def both(texts: pa.Array) -> pa.Array:
        bpe = worker_bpe(path)
        coded, back = [], []
        for raw, offsets in slices(texts):
            ids, counts = bpe.encode(raw, offsets)
            data, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
            coded += [data[4 * a:4 * b] for a, b in zip((ends - counts).tolist(), ends.tolist())]
            back += bpe.decode(ids, counts)
        return pa.StructArray.from_arrays([pa.array(coded, pa.binary()), pa.array(back, pa.binary())], ["ids", "decoded"])
    return F.arrow_udf(both, "struct<ids:binary,decoded:binary>")


def byte_bpe(text: Column, path: str) -> Column:
    """The column's texts encoded by the rank file at ``path``, and decoded."""
    return bpe_udf(path)(text)
