"""Near-duplicate documents by MinHash with tensored banding.

A document is its set of distinct shingles. Two collections of SIDE bands of
BAND_ROWS minhashes each give SIDE ** 2 table keys, one for each pair of a
band of the first and a band of the second: 2 * SIDE * BAND_ROWS minhashes
stand for tables that would cost SIDE ** 2 * 2 * BAND_ROWS on their own. A pair
of similarity s shares a key with probability (1 - (1 - s**BAND_ROWS)**SIDE)**2,
0.99993 at 0.8.

Equal sets are one node from the start, so copies cost nothing later. Nodes
that share a key are put into candidate groups, and inside a group every link
that matters for its components is confirmed on the full sets: a member's
intersections with all others are counted at once, smallest components first,
until those left are all in one component. A group beyond GROUP_SHINGLES is
dealt out as pairs of blocks, each a task of its own.

A text lower-cases A-Z, and its words are the runs of ``[^\\x20\\x09-\\x0D]``;
with fewer words than a shingle takes, the whole sequence is one shingle.
Shingles are compared by 64-bit hashes, equal sets by 128-bit ones.

Defined results: a null text, or one without a word, has an empty set and
links with nothing. A row without a doc_id links with nothing, has a null
component and is kept. Rows that repeat a doc_id are one node if their sets
are equal; else links of either reach the id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import keep, slices
from citeweave.llm.components import components
from citeweave.llm.words import hashes

SIDE, BAND_ROWS = 10, 2
SIMILARITY = 80  # per cent
#: Shingles of one group that a task compares at once.
GROUP_SHINGLES = 1_000_000

_RNG = np.random.default_rng(6)
_WEIGHTS = _RNG.integers(0, 2**64, 256, np.uint64)
_MUL = _RNG.integers(0, 2**63, 2 * SIDE * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**64, 2 * SIDE * BAND_ROWS, np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    n = len(offsets) - 1
    solid = ~_BLANK[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[firsts] |= solid[firsts]
    at = np.flatnonzero(begins)
    place = np.concatenate([[0], np.cumsum(solid)])
    word = hashes(_WEIGHTS[_LOWER[raw[solid]]], place[at])
    words = np.searchsorted(at, offsets)  # index of each text's first word
    odd = np.random.default_rng(width).integers(0, 2**63, width, np.uint64) * np.uint64(2) + np.uint64(1)
    many = max(0, len(word) - width + 1)
    shingle = np.zeros(many, np.uint64)
    for k in range(width):
        shingle += _mixed(word[k:k + many]) * odd[k]
    shingle = _mixed(shingle)
    out = []
    for a, b in zip(words[:-1].tolist(), words[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(shingle[a:b - width + 1]))
        elif b > a:
            out.append(_mixed((_mixed(word[a:b]) * odd[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minhashes of sets that are not empty, 32 bits each."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(_MUL)), np.uint32)
    for k in range(len(_MUL)):
        out[:, k] = np.minimum.reduceat(flat * _MUL[k] + _ADD[k], starts) >> np.uint64(32)
    return out


def table_keys(signature: np.ndarray) -> np.ndarray:
    """The SIDE ** 2 keys of each row: all pairs of a first and a second band."""
    bands = signature.reshape(len(signature), 2 * SIDE, BAND_ROWS)
    value = np.zeros(bands.shape[:2], np.uint64)
    for k in range(BAND_ROWS):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k] + np.uint64(1))
    value += np.arange(2 * SIDE, dtype=np.uint64)
    first, second = _mixed(value[:, :SIDE]), _mixed(value[:, SIDE:])
    return _mixed(first[:, :, None] * np.uint64(0xC2B2AE3D27D4EB4F) + second[:, None, :]).reshape(len(signature), -1)


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, digest, signature), the last two null for an empty set."""
    def of(batches):
        for batch in batches:
            done = 0
            for raw, offsets in slices(batch.column(1)):
                sets = shingle_sets(raw, offsets, width)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full).astype("<u4")) if full else iter(())
                sig = [next(rows).tobytes() if len(s) else None for s in sets]
                digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "signature"])
                done += len(sets)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(of, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """(a, b): each node with the smallest one that shares one of its keys."""
    def keyed(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u4").reshape(part.num_rows, -1)
                keys = table_keys(sig)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(part.column(0).to_numpy(), keys.shape[1]))],
                                                 ["key", "node"])

    def starred(batches):
        key, first = None, 0
        for batch in batches:
            keys, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            new = np.empty(len(keys), bool)
            new[0] = key is None or keys[0] != key
            new[1:] = keys[1:] != keys[:-1]
            run = np.cumsum(new)  # 0: goes on from the batch before
            least = np.concatenate([[first], node[new]])[run]
            key, first = keys[-1], int(least[-1])
            pairs = np.unique(np.stack([node, least], 1)[node != least], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    keys = nodes.select("node", "signature").mapInArrow(keyed, "key bigint, node bigint")
    return keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(starred, "a bigint, b bigint").distinct()


def linked(sets: list[np.ndarray], similarity: int) -> np.ndarray:
    """For each set the smallest index of its component under links of at least ``similarity`` per cent."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, term = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(term, kind="stable")
    posting = owner[order]
    ends = np.cumsum(np.bincount(term))
    begins = np.concatenate([[0], ends[:-1]])
    start = np.cumsum(size) - size
    label, done = np.arange(m), np.zeros(m, bool)
    while True:
        names, count = np.unique(label[~done], return_counts=True)
        if len(names) <= 1:
            return label
        r = int(np.flatnonzero(~done & (label == names[count.argmin()]))[0])
        own = term[start[r]:start[r] + size[r]]
        n = ends[own] - begins[own]
        at = np.repeat(begins[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(posting[at], minlength=m)
        near = 100 * both >= similarity * (size[r] + size - both)
        touched = np.unique(label[near])
        label[np.isin(label, touched)] = touched[0]
        done[r] = True


def confirmed_edges(docs: DataFrame, groups: DataFrame, width: int, similarity: int) -> DataFrame:
    """(a, b): each node with the smallest of its component inside its candidate
    group, or inside each pair of the group's blocks. groups: (node, label, n_shingles)."""
    sizes = groups.groupBy("label").agg(F.ceil(F.sum("n_shingles") / GROUP_SHINGLES).cast("int").alias("blocks"))
    sizes = keep(sizes, "group-sizes")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (F.col("blocks") == 1) | (x != F.col("block"))))
    dealt = groups.join(sizes, "label").withColumn("block", block).select("node", "label", "block", other.alias("other")) \
        .select("node", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def own_sets(batches):
        for batch in batches:
            done = 0
            for raw, offsets in slices(batch.column(1)):
                sets = shingle_sets(raw, offsets, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["doc_id", "shingles"])
                done += len(sets)

    def confirmed(batches):
        key, nodes, sets = None, [], []

        def links():
            label = linked(sets, similarity)
            return [(nodes[i], nodes[k]) for i, k in enumerate(label.tolist()) if i != k]

        out = []
        for batch in batches:
            for label, i, j, node, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (label, i, j) != key:
                    if len(nodes) > 1:
                        out += links()
                    key, nodes, sets = (label, i, j), [], []
                nodes.append(node)
                sets.append(np.frombuffer(data, np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])
                out = []
        if len(nodes) > 1 and (out := links()):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])

    # A node's set is made once and then goes to each of its tasks.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(groups.select("node"), F.col("doc_id") == F.col("node"), "left_semi")
    sets = texts.mapInArrow(own_sets, "doc_id bigint, shingles binary")
    rows = sets.join(dealt, F.col("doc_id") == F.col("node")).select("label", "i", "j", "node", "shingles")
    return rows.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "node").mapInArrow(confirmed, "a bigint, b bigint")


def near_dedup(docs: DataFrame, width: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable) and kept for each row of ``docs``."""
    rows = keep(set_table(docs, width), "shingle-sets")
    full = rows.where("digest is not null and doc_id is not null")
    nodes = keep(full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")), "nodes")
    groups = components(keep(candidate_edges(nodes), "candidates"))
    groups = keep(groups.join(nodes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node").select("node", "label", "n_shingles"), "candidate-groups")
    # An id that stands for two different sets ties them together.
    repeated = full.join(nodes.select("digest", "node"), "digest").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    links = confirmed_edges(docs, groups, width, similarity)
    found = components(links.unionAll(repeated))
    labelled = rows.join(found, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("label", "doc_id")
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
