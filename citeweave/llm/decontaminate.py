"""Benchmark decontamination with a BM25 index of the test items.

The index is of the test items; every passage of every training text queries
it. A passage is two neighbouring runs of STRIDE words, so whatever STRIDE
words stand together lie in one passage. An item's threshold is THRESHOLD of
the score that its own words get, of STRIDE words' share if it is longer; all
items at or above theirs are retrieved. Block-max WAND does that without
scoring the rest: items lie in blocks, a term knows its greatest impact
overall and in each block, and a passage goes on to pivoting only if the block
impacts of its terms can reach a threshold; pivoting then skips blocks that
cannot.

A retrieved item is verified on the text around its passage: SIMILARITY of its
five-word shingles must be there (an item of fewer words is one shingle), and of the words of its answer, which is its
last sentence if it has several.

The test items are dealt to shards of SHARD_BYTES of text at most, by hash.
Each shard has an index of its own, with its own term statistics, that goes
to the tasks; the training texts never move.

Words are runs of letters and digits, lower-cased. Defined results: a null or
wordless text has no items; an item without words is never found; equal items
are each reported; a repeated row reports its pairs again. Other columns are
not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import slices
from citeweave.llm.words import hashes

STRIDE = 32
THRESHOLD = 0.8
SHINGLE, SIMILARITY = 5, 0.8
K1, B = 1.2, 0.75
LEAST_BLOCK, MOST_BLOCKS = 8, 32
SHARD_BYTES = 4_000_000
#: Bounds are sums of 32-bit floats; this much below the threshold still goes on.
SLACK = 1e-3

_WEIGHTS = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64)
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word and the end) of lower-cased texts."""
    solid = _WORD[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[firsts] |= solid[firsts]
    at = np.flatnonzero(begins)
    place = np.concatenate([[0], np.cumsum(solid)])
    return hashes(_WEIGHTS[raw[solid]], place[at]), np.searchsorted(at, offsets)


def lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def shingles(word: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the runs of n words."""
    if len(word) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(word) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word[k:k + len(out)]
    return np.unique(out)


class Index:
    """Items as (id, text): postings, impacts over thresholds, block maxima."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.words, self.answers = [], [], []
        for i, text in sorted(items, key=lambda x: (x[0] is None, x[0], x[1])):
            parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
            cut = pa.array([" ".join(parts[:-1]), parts[-1]] if len(parts) > 1 else [text, ""])
            (raw, offsets), = slices(lower(cut), 1 << 62)
            word, first = words(raw, offsets)
            if len(word):
                self.ids.append(i)
                self.words.append(word)
                self.answers.append(np.unique(word[first[1]:]))
        self.shingles = [shingles(w, min(SHINGLE, len(w))) for w in self.words]
        n = len(self.ids)
        size = np.array([len(w) for w in self.words], float)
        counts = [np.unique(w, return_counts=True) for w in self.words]
        self.vocab, term = np.unique(np.concatenate([c[0] for c in counts]) if n else np.zeros(0, np.uint64), return_inverse=True)
        item = np.repeat(np.arange(n), [len(c[0]) for c in counts]) if n else np.zeros(0, int)
        tf = np.concatenate([c[1] for c in counts]).astype(float) if n else np.zeros(0)
        df = np.bincount(term, minlength=len(self.vocab))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / size.mean())) if n else tf
        own = np.bincount(item, impact, n)
        impact /= (THRESHOLD * own * np.minimum(1, STRIDE / size))[item] if n else 1  # an item is found from 1 on
        order = np.lexsort((item, term))
        edges = np.cumsum(df)[:-1]
        self.postings = [x.tolist() for x in np.split(item[order], edges)] if n else []
        self.impacts = [x.tolist() for x in np.split(impact[order], edges)] if n else []
        self.block = max(LEAST_BLOCK, math.ceil(n / MOST_BLOCKS))
        self.maxima = np.zeros((len(self.vocab), math.ceil(n / self.block)), np.float32)
        np.maximum.at(self.maxima, (term, item // self.block), impact.astype(np.float32))
        self.most = self.maxima.max(1, initial=0).tolist()

    def terms(self, word: np.ndarray) -> np.ndarray:
        """The term of each word, -1 if no item has it."""
        k = np.minimum(np.searchsorted(self.vocab, word), len(self.vocab) - 1)
        return np.where(self.vocab[k] == word, k, -1)

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """(item, score over threshold) of all items from 1 on, for a passage's distinct terms."""
        cursors = [[self.postings[t][0], 0, t] for t in terms]
        found, goal = [], 1 - SLACK
        while cursors:
            cursors.sort()
            bound, p = 0.0, -1
            for k, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= goal:
                    p = k
                    break
            if p < 0:
                break
            pivot = cursors[p][0]
            while p + 1 < len(cursors) and cursors[p + 1][0] == pivot:
                p += 1
            block = pivot // self.block
            if sum(float(self.maxima[c[2], block]) for c in cursors[:p + 1]) < goal:
                # no item up to the block's end, or to the next list's item, can get there
                to = (block + 1) * self.block
                if p + 1 < len(cursors):
                    to = min(to, cursors[p + 1][0])
            elif cursors[0][0] == pivot:
                score = sum(self.impacts[c[2]][c[1]] for c in cursors[:p + 1])
                if score >= 1 - 1e-9:
                    found.append((pivot, score))
                to = pivot + 1
            else:
                to = pivot
            left = []
            for c in cursors:
                if c[0] < to:
                    c[1] = bisect_left(self.postings[c[2]], to, c[1])
                    if c[1] == len(self.postings[c[2]]):
                        continue
                    c[0] = self.postings[c[2]][c[1]]
                left.append(c)
            cursors = left
        return found

    def leaks(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, overlap, answer overlap) of the verified items in lower-cased texts."""
        word, first = words(raw, offsets)
        if not len(word) or not len(self.vocab):
            return []
        size = np.diff(first)
        runs = -(-size // STRIDE)
        run_first = np.cumsum(runs) - runs
        text = np.repeat(np.arange(len(size)), size)
        run = run_first[text] + (np.arange(len(word)) - first[text]) // STRIDE
        term = self.terms(word)
        here = np.flatnonzero(term >= 0)
        if not len(here):
            return []
        key = np.unique(run[here] * len(self.vocab) + term[here])
        key_run, key_term = key // len(self.vocab), key % len(self.vocab)
        begin = np.flatnonzero(np.diff(key_run, prepend=-1))
        bound = np.zeros((int(runs.sum()) + 1, self.maxima.shape[1]), np.float32)
        bound[key_run[begin]] = np.add.reduceat(self.maxima[key_term], begin)
        run_text = np.repeat(np.arange(len(size)), runs)
        paired = np.append(run_text[1:] == run_text[:-1], False)
        both = bound[:-1] + np.where(paired[:, None], bound[1:], 0)
        out: dict[tuple[int, int], tuple[float, float, float]] = {}
        for r in np.flatnonzero(both.max(1) >= 1 - SLACK).tolist():
            t = int(run_text[r])
            a, b = np.searchsorted(key_run, [r, r + 1 + int(paired[r])])
            for item, score in self.search(np.unique(key_term[a:b]).tolist()):
                start, more = int(first[t]) + (r - int(run_first[t])) * STRIDE, len(self.words[item])
                near = word[max(int(first[t]), start - more):min(int(first[t + 1]), start + 2 * STRIDE + more)]
                overlap = float(np.isin(self.shingles[item], shingles(near, min(SHINGLE, more))).mean())
                answer = float(np.isin(self.answers[item], near).mean()) if len(self.answers[item]) else 1.0
                if overlap >= SIMILARITY and answer >= SIMILARITY:
                    out[t, item] = max(out.get((t, item), (0.0, 0.0, 0.0)), (score * THRESHOLD, overlap, answer))
        return [(t, item, *found) for (t, item), found in sorted(out.items())]


def shards(benchmark: DataFrame) -> list[Index]:
    """Indexes of bounded size over all items of ``benchmark`` (item_id, text)."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(size / SHARD_BYTES)
    return [Index([(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()])
            for k in range(n)]


def leaked_items(text: Column, benchmark: DataFrame) -> Column:
    """array<bigint>: ids of the items found in the text, in order, one for each item row."""
    def of(index: Index):
        def scan(texts: pa.Array) -> pa.Array:
            out: list[list] = [[] for _ in range(len(texts))]
            done = 0
            for raw, offsets in slices(lower(texts)):
                for t, item, *_ in index.leaks(raw, offsets):
                    out[done + t].append(index.ids[item])
                done += len(offsets) - 1
            return pa.array(out, pa.list_(pa.int64()))
        return F.arrow_udf(scan, "array<bigint>")(text)

    found = [of(index) for index in shards(benchmark)]
    return F.sort_array(F.concat(F.array().cast("array<bigint>"), *found))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, overlap, answer_overlap), a row for each item found in a document."""
    schema = "doc_id bigint, item_id bigint, score double, overlap double, answer_overlap double"

    def of(index: Index):
        def scan(batches):
            for batch in batches:
                ids, done, rows = batch.column(0).to_pylist(), 0, []
                for raw, offsets in slices(lower(batch.column(1))):
                    rows += [(ids[done + t], index.ids[item], *found) for t, item, *found in index.leaks(raw, offsets)]
                    done += len(offsets) - 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 2 + [pa.float64()] * 3)],
                                                     ["doc_id", "item_id", "score", "overlap", "answer_overlap"])
        return scan

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    out = None
    for index in shards(benchmark):
        found = texts.mapInArrow(of(index), schema)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)
