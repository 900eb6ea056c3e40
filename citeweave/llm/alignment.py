"""Alignment of two tokenizers by an inverted index of document bitmaps.

Every text, with one space before it, is cut by a byte-level BPE tokenizer (A)
and a piece tokenizer (B, which adds that space itself). Byte offsets where
tokens of both end cut the text into groups; an A and a B token whose byte
ranges overlap are a link.

1. One pass over the texts. Both tokenizers cut before a space that follows
   something other than white space, so a text falls into units that are
   encoded on their own, each distinct unit once in a worker. (The B vocabulary is
   checked: none of its pieces holds a space after something else; else a text is
   one unit.) A task deals its documents out to chunks of at most CHUNK
   documents and inverts a chunk: for every id pair a bitmap of the documents
   that hold it linked, and multiplicity planes, where plane k has the documents
   with bit k - 1 of (number of links - 1) set. Bitmaps are compressed like a
   Roaring bitmap's containers: sorted 16-bit places, or plain bits where that
   is shorter.
2. OR-merging a pair's bitmaps puts containers of different chunks side by side,
   since chunks share no documents; so its document count is the sum of the
   containers' popcounts, and its link count that of the planes' popcounts by
   their weights. Both are partial aggregates: a pair in every document is one
   row for each chunk and task.
3. Postings meet their pair's count and whether that is its A id's highest, and
   return to their chunk, where every document's scores are added up in
   two numbers for each place.

A task holds the postings of one chunk, HELD incidences and one slice of texts
at most (a longer text is handled alone), never all postings of a pair.

Defined results: a text that is null, empty, or whose joined token bytes of either
tokenizer are not the bytes of space and text (such as one with U+2581 in it) has no
tokens, zeros everywhere and an empty digest. Each row is a document of its own:
rows that repeat a doc_id count apart, and a null doc_id is a document too. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keep, slices
from citeweave.llm.words import SPACE, _classes, _weights, hashes

#: Documents of a chunk, at most, and (document, pair) incidences after which it is closed.
CHUNK, HELD = 8192, 3_000_000
#: Units, and pair entries of units, that a worker remembers; it starts anew beyond that.
REMEMBERED, REMEMBERED_PAIRS = 500_000, 8_000_000
_PLAIN = CHUNK // 8  # bytes of an uncompressed container
_B_BITS = np.int64(32)

_DOCS = "chunk bigint, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string"
_POSTINGS = "pair bigint, plane int, n bigint, bits binary"


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte_of = self._byte_level()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = pieces.index("▁")
        #: Whether B cuts before every run of spaces.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    @staticmethod
    def _byte_level() -> dict[str, int]:
        """The byte that each character of a byte-level token stands for: printable Latin-1
        ones stand for themselves, the others count on from U+0100."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in own]
        return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A's and B's ids of units that begin with a space."""
        a = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        b = [ids or [self.space] for ids in self.b.encode([u[1:] for u in units], num_threads=1)]
        return a, b


def links(a_end: np.ndarray, a_size: np.ndarray, b_end: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all A and B tokens whose byte ranges overlap; ends ascend, sizes are over 0."""
    low = np.searchsorted(b_end, a_end - a_size, "right")
    n = np.searchsorted(b_end - b_size, a_end, "left") - low
    return np.repeat(np.arange(len(a_end)), n), np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Units:
    """What a worker remembers of the units it has met."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self._clear()

    def _clear(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts = np.zeros((0, 5), np.int64)  # A tokens, B tokens, groups, links, 1 if the bytes agree
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.entries, self.pairs = np.zeros((2, 1 << 16), np.int64), 0  # pair and number of links; how many are in use
        self.groups: list[bytes] = []

    def lookup(self, keys: np.ndarray, unit) -> np.ndarray:
        """Indexes of units by their sorted hashes; ``unit`` gives the text of the k-th."""
        if len(self.keys) + len(keys) > REMEMBERED or self.pairs > REMEMBERED_PAIRS:
            self._clear()
        known = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[known] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            self._add(keys[new], [unit(k) for k in new.tolist()])
        return self.place[np.searchsorted(self.keys, keys)]

    def _add(self, keys: np.ndarray, units: list[str]) -> None:
        t = self.tokenizers
        a_ids, b_ids = t.encode(units)
        raw = [u.encode() for u in units]
        fine = np.array([b"".join([t.a_bytes[i] for i in a]) == r and b"".join([t.b_bytes[i] for i in b]) == r for a, b, r in zip(a_ids, b_ids, raw)])
        good = np.flatnonzero(fine).tolist()
        counts = np.zeros((len(units), 5), np.int64)
        counts[:, 4] = fine
        groups = [b""] * len(units)
        size = np.zeros(len(units), np.int64)
        if good:
            n_a, n_b = (np.array([len(x[k]) for k in good]) for x in (a_ids, b_ids))
            a, b = (np.concatenate([x[k] for k in good]).astype(np.int64) for x in (a_ids, b_ids))
            a_size, b_size = t.a_size[a], t.b_size[b]
            a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)  # both run over the good units' joined bytes
            cuts = np.intersect1d(a_end, b_end, assume_unique=True)
            own = np.repeat(np.arange(len(good)), n_a)
            x, y = links(a_end, a_size, b_end, b_size)
            counts[good, 0], counts[good, 1] = n_a, n_b
            counts[good, 2] = np.bincount(own[np.searchsorted(a_end, cuts)], minlength=len(good))
            counts[good, 3] = np.bincount(own[x], minlength=len(good))
            pair = (a[x] << _B_BITS) | b[y]
            order = np.lexsort((pair, own[x]))
            pair, unit = pair[order], own[x][order]
            first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (unit[1:] != unit[:-1])))
            size[good] = np.bincount(unit[first], minlength=len(good))
            while self.pairs + len(first) > self.entries.shape[1]:
                self.entries = np.concatenate([self.entries, np.zeros_like(self.entries)], 1)
            self.entries[:, self.pairs:self.pairs + len(first)] = pair[first], np.diff(np.append(first, len(pair)))
            sa, sb = a.astype(str).tolist(), b.astype(str).tolist()
            ga, gb = np.append(0, np.searchsorted(a_end, cuts) + 1).tolist(), np.append(0, np.searchsorted(b_end, cuts) + 1).tolist()
            every = [",".join(sa[i:j]) + "|" + ",".join(sb[k:m]) for i, j, k, m in zip(ga, ga[1:], gb, gb[1:])]
            ends = np.cumsum(counts[good, 2]).tolist()
            for k, i, j in zip(good, [0, *ends], ends):
                groups[k] = ";".join(every[i:j]).encode()
        place = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, place, len(self.groups) + np.arange(len(keys)))
        self.keys = np.insert(self.keys, place, keys)
        self.counts = np.concatenate([self.counts, counts])
        self.at = np.concatenate([self.at, self.pairs + np.cumsum(size) - size])
        self.pairs += int(size.sum())
        self.size = np.concatenate([self.size, size])
        self.groups += groups


@lru_cache(1)
def _worker_units(a_path: str, b_path: str) -> Units:
    return Units(Tokenizers(a_path, b_path))


def units_of(raw: np.ndarray, offsets: np.ndarray, cuts: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """(all texts as one string, its code points, first code point of each unit, text of each unit)."""
    text = raw.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    first = offsets if len(points) == len(raw) else np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    mark = np.zeros(len(points), bool)
    if cuts:
        mark[1:] = (points[1:] == 32) & (_classes()[points[:-1]] != SPACE)
    mark[first[:-1]] = True
    starts = np.flatnonzero(mark)
    return text, points, starts, np.searchsorted(first, starts, "right") - 1


def containers(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first row, rows, container) of each key; rows are sorted by key and place."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(key)))
    plain = np.flatnonzero(2 * n >= _PLAIN)
    size = np.minimum(2 * n, _PLAIN)
    ends = np.cumsum(size)
    data = np.zeros(int(size.sum()), np.uint8)
    listed = np.repeat(2 * n < _PLAIN, n)
    at = np.repeat(2 * n < _PLAIN, size)
    data[at] = place[listed].astype("<u2").view(np.uint8)
    for k in plain.tolist():
        bits = np.zeros(CHUNK, bool)
        bits[place[first[k]:first[k] + n[k]]] = True
        data[ends[k] - _PLAIN:ends[k]] = np.packbits(bits)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return first, n, pa.Array.from_buffers(pa.binary(), len(first), [None, offsets.buffers()[1], pa.py_buffer(data)])


def members(bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(container, place) of every document in the containers."""
    offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset:bits.offset + len(bits) + 1].astype(np.int64)
    data = np.frombuffer(bits.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets, size = offsets - offsets[0], np.diff(offsets)
    listed = np.repeat(size < _PLAIN, size)
    row = np.repeat(np.arange(len(size)), np.where(size < _PLAIN, size // 2, 0))
    rows, places = [row], [np.ascontiguousarray(data[listed]).view("<u2").astype(np.int64)]
    for k in np.flatnonzero(size == _PLAIN).tolist():
        found = np.flatnonzero(np.unpackbits(data[offsets[k]:offsets[k + 1]]))
        rows.append(np.full(len(found), k))
        places.append(found)
    return np.concatenate(rows), np.concatenate(places)


def index(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """A row for each document (pair is null), and the postings: (pair, chunk, plane, n, bits)."""
    schema = f"{_DOCS}, {_POSTINGS}"
    names = [c.split()[0] for c in schema.split(", ")]
    number = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def batch_of(length: int, **columns):
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(length, t) for c, t in zip(names, number)], names)

    def of(batches):
        known = _worker_units(a_path, b_path)
        chunk, place, held, parts = TaskContext.get().partitionId() << 33, 0, 0, []

        def postings():
            # Pairs as small numbers, so that one number sorts by pair and place.
            pairs, code = np.unique(np.concatenate([p for p, _, _ in parts]), return_inverse=True)
            key = code * CHUNK + np.concatenate([d for _, d, _ in parts])
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            more = np.add.reduceat(np.concatenate([m for _, _, m in parts])[order], first) - 1
            key = key[first]
            for plane in range(int(more.max()).bit_length() + 1):
                own = key if plane == 0 else key[(more >> (plane - 1)) & 1 == 1]
                at, n, bits = containers(own // CHUNK, own % CHUNK)
                yield batch_of(len(n), chunk=pa.array(np.full(len(n), chunk)), pair=pa.array(pairs[own[at] // CHUNK]), n=pa.array(n),
                               plane=pa.array(np.full(len(n), plane, np.int32)), bits=bits)

        for batch in batches:
            ids, done = batch.column(0), 0
            texts = batch.column(1).fill_null("")
            full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for raw, offsets in slices(pc.binary_join_element_wise(" ", texts, "")):
                n = len(offsets) - 1
                text, points, starts, owner = units_of(raw, offsets, known.tokenizers.cuts)
                keys, at, which = np.unique(hashes(_weights()[points], starts), return_index=True, return_inverse=True)
                ends = np.append(starts[1:], len(points))
                unit = known.lookup(keys, lambda k: text[starts[at[k]]:ends[at[k]]])[which]
                counts = known.counts[unit]
                fine = full[done:done + n] & (np.bincount(owner, counts[:, 4] == 0, n) == 0)
                totals = [np.where(fine, np.bincount(owner, counts[:, k], n).astype(np.int64), 0) for k in range(4)]
                places = []
                edges = np.searchsorted(owner, np.arange(n + 1))
                sha, groups, listed = [], [], unit.tolist()
                for i in range(n):
                    own = b";".join([known.groups[u] for u in listed[edges[i]:edges[i + 1]]]) if fine[i] else b""
                    sha.append(hashlib.sha256(own).hexdigest() if fine[i] else "")
                    groups.append(own.decode() if with_groups else None)
                # Documents go to the chunk one after another; the postings of each unit once a document.
                stays = fine[owner]
                seen, times = np.unique(owner[stays] * len(known.groups) + unit[stays], return_counts=True)
                doc, u = seen // max(1, len(known.groups)), seen % max(1, len(known.groups))
                per_doc = np.bincount(doc, known.size[u], n).astype(np.int64)
                chunks, i = [], 0
                while i < n:
                    room = int(np.searchsorted(np.cumsum(per_doc[i:]), max(1, HELD - held), "right"))
                    j = min(n, i + max(room, 0 if held else 1), i + CHUNK - place)
                    if j > i:
                        x, y = np.searchsorted(doc, [i, j])
                        size = known.size[u[x:y]]
                        rows = np.repeat(known.at[u[x:y]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                        parts.append((known.entries[0, rows], np.repeat(doc[x:y] - i + place, size), known.entries[1, rows] * np.repeat(times[x:y], size)))
                        places.append(np.arange(place, place + j - i))
                        chunks.append(np.full(j - i, chunk))
                        held += len(rows)
                        place += j - i
                        i = j
                    if i < n:
                        if held:
                            yield from postings()
                        chunk, place, held, parts = chunk + 1, 0, 0, []
                yield batch_of(n, chunk=pa.array(np.concatenate(chunks)), place=pa.array(np.concatenate(places).astype(np.int32)), doc_id=ids.slice(done, n),
                               groups_sha256=pa.array(sha), groups=pa.array(groups, pa.string()),
                               **{c: pa.array(x) for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), totals)})
                done += n
        if held:
            yield from postings()
        give_back()

    return keep(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, schema), "alignment-index")


def _postings(indexed: DataFrame) -> DataFrame:
    return indexed.where("pair is not null").select("pair", "chunk", "plane", "n", "bits")


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best) of every id pair; best: no other pair of its A id is in more documents."""
    weight = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    counts = _postings(indexed).groupBy("pair").agg(F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("n_docs"), F.sum(F.col("n") * weight).alias("n_links"))
    counts = keep(counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    highest = counts.groupBy(F.col("a").alias("a_id")).agg(F.max("n_docs").alias("most"))
    return keep(counts.join(highest, F.col("a") == F.col("a_id")).select(
        "pair", "a", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best")), "best-pairs")


def document_scores(indexed: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, place, n_best, count_sum): of each document the links whose pair is the best
    of its A id, and the document counts of all its links, added up."""
    def of(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, plane, n_docs = (batch.column(k).to_numpy() for k in range(3))
            best = batch.column(3).to_numpy(zero_copy_only=False)
            row, place = members(batch.column(4))
            weight = np.int64(1) << np.maximum(plane - 1, 0).astype(np.int64)
            for c in np.unique(chunk).tolist():
                own = chunk[row] == c
                if c not in totals:
                    totals[c] = np.zeros((2, CHUNK), np.int64)
                for sums, score in zip(totals[c], (weight * best, weight * n_docs)):
                    sums += np.bincount(place[own], score[row[own]], CHUNK).astype(np.int64)
        for c, sums in totals.items():
            places = np.flatnonzero(sums[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), c)), pa.array(places.astype(np.int32)), pa.array(sums[0][places]), pa.array(sums[1][places])],
                                             ["chunk", "place", "n_best", "count_sum"])
        give_back()

    scored = _postings(indexed).join(counts.select(F.col("pair").alias("counted"), "n_docs", "best"), F.col("pair") == F.col("counted"))
    return scored.select("chunk", "plane", "n_docs", "best", "bits").repartition("chunk") \
        .mapInArrow(of, "chunk bigint, place int, n_best bigint, count_sum bigint")


def align(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Of each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    and, if asked for, groups (`a1,a2|b1;a3|b2,b3`); and the counts of all pairs."""
    indexed = index(docs, a_path, b_path, with_groups)
    counts = pair_counts(indexed)
    scores = document_scores(indexed, counts).select(F.col("chunk").alias("c"), F.col("place").alias("p"), "n_best", "count_sum")
    rows = indexed.where("pair is null").join(scores, (F.col("chunk") == F.col("c")) & (F.col("place") == F.col("p")), "left")
    found = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
                        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256", *(["groups"] if with_groups else []))
    return found, counts.drop("pair")
