"""Token ids in binary files, coded by a static range asymmetric numeral system.

The file format. A table is a folder of Parquet files; a row is a *group*:
whole documents in ascending order, about GROUP_TOKENS ids, and one frequency
table that all blocks of the group share. A block is BLOCK_STEPS * LANES ids
(the last one of a group may be shorter): LANES coder states advance in turn
over the ids and share one stream of 32-bit words. Blocks do not depend on
each other. Each has a crc32 over its states and words, and every
CHECKPOINT_STEPS steps the states and the place in the stream are kept, so
that a reader starts at each checkpoint at once and decodes all of a group's
blocks and checkpoints side by side.

A group's bytes: HEADER, doc ids, a byte for each id that is null, numbers of
ids of the documents, the zlib-packed frequencies, then for each block its
number of words, crc32, states, checkpoints and words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, slices
from citeweave.session import scratch_path

LANES, BLOCK_STEPS, CHECKPOINT_STEPS = 32, 1024, 256
GROUP_TOKENS = 1 << 20
#: Frequencies of a table add up to 2 ** BITS; states stay in [2 ** 31, 2 ** 63).
BITS = 18
LOW = np.uint64(1 << 31)
HEADER = struct.Struct("<4sIIQIII")  # magic, version, documents, ids, blocks, size of the vocabulary, bytes of the table
MAGIC, VERSION = b"RNSG", 1
U32, U18, MASK = np.uint64(32), np.uint64(BITS), np.uint64((1 << BITS) - 1)


def frequencies(ids: np.ndarray) -> np.ndarray:
    """Counts of the ids scaled to 2 ** BITS, at least 1 for each id that occurs."""
    counts = np.bincount(ids) if len(ids) else np.ones(1, np.int64)
    total, present = 1 << BITS, counts > 0
    if present.sum() > total:
        raise ValueError(f"more than {total} distinct ids")
    out = np.maximum(counts * total // counts.sum(), present)
    over = int(out.sum()) - total
    if over < 0:
        out[out.argmax()] -= over
    elif over:  # the ones that were lifted to 1 are paid for by the most frequent
        for i in np.argsort(-out, kind="stable"):
            take = min(over, int(out[i]) - 1)
            out[i] -= take
            over -= take
            if not over:
                break
    return out


def _tables(freq: np.ndarray):
    freq = freq.astype(np.uint64)
    return freq, np.cumsum(freq) - freq


def encode_blocks(ids: np.ndarray, freq: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: (states, checkpoint states, their places, words). ``ids`` are
    whole blocks of one length, an id for each step and lane."""
    n, steps = ids.shape[:2]
    freq, below = _tables(freq)
    x = np.full((n, LANES), LOW, np.uint64)
    words, block, kept = [], [], []
    for s in range(steps - 1, -1, -1):
        f = freq[ids[:, s]]
        full = x >= (f << np.uint64(63 - BITS))
        words.append(x[full].astype(np.uint32))  # the low 32 bits
        block.append(np.nonzero(full)[0].astype(np.uint16))
        x[full] >>= U32
        q = x // f
        x = (q << U18) + (x - q * f) + below[ids[:, s]]
        if s and s % CHECKPOINT_STEPS == 0:
            kept.append((x.copy(), len(words)))
    owner = np.concatenate(block[::-1])
    stream = np.concatenate(words[::-1])
    total = np.bincount(owner, minlength=n)
    order = np.argsort(owner, kind="stable")
    streams = np.split(stream[order], np.cumsum(total)[:-1])
    states, places = [], []
    for at, k in kept[::-1]:
        states.append(at)
        places.append(total - np.bincount(np.concatenate(block[:k]), minlength=n))
    states = np.stack(states, 1) if states else np.zeros((n, 0, LANES), np.uint64)
    places = np.stack(places, 1).astype(np.uint32) if places else np.zeros((n, 0), np.uint32)
    return [(x[i], states[i], places[i], streams[i]) for i in range(n)]


def decode_rows(x: np.ndarray, at: np.ndarray, words: np.ndarray, steps: int, freq, below, symbol) -> np.ndarray:
    """The ids that ``steps`` steps give from the states x (rows, LANES); at: each row's place in ``words``."""
    out = np.empty((len(x), steps, LANES), np.uint32)
    at = at.astype(np.int64).copy()
    for s in range(steps):
        slot = x & MASK
        ids = symbol[slot]
        out[:, s] = ids
        x = freq[ids] * (x >> U18) + slot - below[ids]
        low = x < LOW
        rank = np.cumsum(low, 1)
        x[low] = (x[low] << U32) | words[(at[:, None] + rank - 1)[low]]
        at += rank[:, -1]
    return out


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A group's bytes."""
    freq = frequencies(ids)
    table = zlib.compress(freq.astype("<u4").tobytes(), 1)
    size = LANES * BLOCK_STEPS
    whole = len(ids) // size
    blocks = encode_blocks(ids[:whole * size].reshape(whole, BLOCK_STEPS, LANES), freq) if whole else []
    rest = ids[whole * size:]
    if len(rest):
        steps = -(-len(rest) // LANES)
        rest = np.concatenate([rest, np.full(steps * LANES - len(rest), rest[-1], ids.dtype)])
        blocks += encode_blocks(rest.reshape(1, steps, LANES), freq)
    out = [HEADER.pack(MAGIC, VERSION, len(doc_ids), len(ids), len(blocks), len(freq), len(table)),
           np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], "u1").tobytes(),
           counts.astype("<u8").tobytes(), table]
    for states, kept, places, words in blocks:
        body = states.astype("<u8").tobytes() + kept.astype("<u8").tobytes() + places.astype("<u4").tobytes() + words.astype("<u4").tobytes()
        out += [struct.pack("<II", len(words), zlib.crc32(body)), body]
    return b"".join(out)


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, numbers of ids, ids) of a group; raises on a damaged one."""
    magic, version, docs, n, n_blocks, vocab, size = HEADER.unpack_from(data)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a group of this format")
    at = HEADER.size
    doc_ids = np.frombuffer(data, "<i8", docs, at).tolist()
    at += 8 * docs
    null = np.frombuffer(data, "u1", docs, at)
    at += docs
    counts = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
    at += 8 * docs
    freq, below = _tables(np.frombuffer(zlib.decompress(data[at:at + size]), "<u4", vocab))
    at += size
    symbol = np.repeat(np.arange(vocab, dtype=np.uint32), freq.astype(np.int64))
    rows, streams, base, left = {}, [], 0, -(-n // LANES)
    for k in range(n_blocks):
        n_words, crc = struct.unpack_from("<II", data, at)
        at += 8
        steps = min(left, BLOCK_STEPS)
        left -= steps
        points = (steps - 1) // CHECKPOINT_STEPS
        length = 8 * LANES * (1 + points) + 4 * points + 4 * n_words
        if zlib.crc32(data[at:at + length]) != crc:
            raise ValueError(f"block {k} of the group starting at document {doc_ids[:1]} is damaged")
        states = np.frombuffer(data, "<u8", LANES * (1 + points), at).reshape(1 + points, LANES)
        places = np.frombuffer(data, "<u4", points, at + states.nbytes)
        streams.append(np.frombuffer(data, "<u4", n_words, at + states.nbytes + places.nbytes))
        for i in range(1 + points):
            span = min(steps - i * CHECKPOINT_STEPS, CHECKPOINT_STEPS)
            rows.setdefault(span, []).append((k * BLOCK_STEPS + i * CHECKPOINT_STEPS, states[i], base + (int(places[i - 1]) if i else 0)))
        base += n_words
        at += length
    words = np.concatenate([*streams, np.zeros(1, "<u4")]).astype(np.uint64)
    out = np.zeros((-(-n // LANES), LANES), np.uint32)
    for span, found in rows.items():
        got = decode_rows(np.stack([x[1] for x in found]), np.array([x[2] for x in found]), words, span, freq, below, symbol)
        for (step, _, _), ids in zip(found, got):
            out[step:step + span] = ids
    return [None if z else x for x, z in zip(doc_ids, null)], counts, out.reshape(-1)[:n]


def write_ids(docs: DataFrame, encoder: Callable[[], Callable], end_id: int, path: str) -> None:
    """Encode (doc_id, text) and write groups in ascending doc_id order (nulls
    first; rows that share a doc_id by their texts) below ``path``.

    ``encoder()`` is called once in each task and gives a function of (bytes,
    offsets) that returns all ids and their numbers by text."""
    def groups(batches):
        encode = encoder()
        file, seq, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, parts, held = [], [], [], 0

        def group():
            nonlocal seq, before, doc_ids, counts, parts, held
            ids = np.concatenate(parts)
            row = pa.RecordBatch.from_pydict({"file": [file], "seq": [seq], "before": [before], "n_ids": [len(ids)],
                                              "data": pa.array([pack(doc_ids, np.concatenate(counts), ids)], pa.binary())})
            seq, before = seq + 1, before + len(ids)
            doc_ids, counts, parts, held = [], [], [], 0
            give_back()
            return row

        for batch in batches:
            own, done = batch.column(0).to_pylist(), 0
            for raw, offsets in slices(batch.column(1)):
                ids, n = encode(raw, offsets)
                ends = np.cumsum(n)
                parts.append(np.insert(ids, ends, end_id))
                counts.append(n + 1)
                doc_ids += own[done:done + len(n)]
                done += len(n)
                held += len(parts[-1])
                if held >= GROUP_TOKENS:
                    yield group()
        if doc_ids:
            yield group()

    key = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", key).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(groups, "file bigint, seq bigint, before bigint, n_ids bigint, data binary") \
        .write.option("compression", "uncompressed").parquet(path)


def read_ids(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32) of the files below ``path``."""
    files = spark.read.schema("file bigint, seq bigint, before bigint, n_ids bigint, data binary").parquet(path)
    # One row for each file, so neither the window nor the broadcast grows with the documents.
    totals = files.groupBy("file").agg(F.sum("n_ids").alias("n"))
    starts = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"))

    def documents(batches):
        for batch in batches:
            for data, start in zip(batch.column("data"), batch.column("start").to_pylist()):
                doc_ids, counts, ids = unpack(data.as_buffer().to_pybytes())
                ends = np.cumsum(counts)
                places = pa.array(np.concatenate([[0], 4 * ends]).astype(np.int32))
                values = pa.Array.from_buffers(pa.binary(), len(counts), [None, places.buffers()[1], pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + ends - counts), pa.array(counts), values],
                                                 ["doc_id", "start", "n_tokens", "ids"])
                give_back()

    return files.join(F.broadcast(starts), "file").select((F.col("before") + F.col("file_start")).alias("start"), "data") \
        .mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


class JsonEncoder:
    """Encodes with the tokenizers library; each distinct piece goes through it once in a worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        from citeweave.llm.words import Known

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab = self.library.get_vocab()
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token)  # a character stands for a byte
        self.known = Known()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Pieces are encoded many at a time, a line break before each: it is a piece
        of its own and keeps them apart. Blank pieces are encoded alone."""
        out = [b""] * len(words)
        rest = []
        for i, w in enumerate(words):
            if w.isspace():
                out[i] = np.array(self.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                rest.append(i)
        for a in range(0, len(rest), 2000):
            part = rest[a:a + 2000]
            got = self.library.encode_batch_fast(["\n" + "\n".join([words[i] for i in part])], add_special_tokens=False)[0]
            ids = np.array(got.ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(words[i].encode()) + 1 for i in part])) + 1
            starts = np.concatenate([[0], ends[:-1]]) + 1
            data = ids.tobytes()
            for i, x, y in zip(part, starts.tolist(), ends.tolist()):
                out[i] = data[4 * x:4 * y]
        return out

    def __call__(self, raw, offsets):
        from citeweave.llm.words import encode

        return encode(raw, offsets, self.known, self.encode_words)


_ENCODERS: dict[str, JsonEncoder] = {}


def json_encoder(path: str) -> JsonEncoder:
    """The worker's encoder; it outlives the task."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    if path not in _ENCODERS:
        _ENCODERS[path] = JsonEncoder(path)
    return _ENCODERS[path]


def coded_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the ids of ``docs`` to files and read them back.

    A null text counts as empty: it has the end id alone. Rows that repeat a
    doc_id are documents of their own, one after the other; a null doc_id
    comes first. Other columns of the table are not read."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, partial(json_encoder, tokenizer_path), end_id, path)
    return read_ids(docs.sparkSession, path)
