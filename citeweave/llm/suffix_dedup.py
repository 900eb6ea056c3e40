"""Removal of repeated 50-byte strings with difference-cover suffix arrays.

Texts are UTF-8 bytes. A byte goes if a 50-byte string covers it that also
starts in a document with a smaller doc_id.

What has to meet in one task is decided by minimizers. A window is a 50-byte
string; its minimizer is the least hash of the 24-byte strings in it, so equal
windows have equal minimizers, wherever they stand. Neighbouring windows with
one minimizer are one segment, up to 76 bytes long unless its text is periodic.

1. Of equal texts the one with the smallest doc_id goes on; the others are
   removed whole if they have a window at all, and take nothing else away.
2. The minimizers of every document are counted; a window whose minimizer is
   in one document alone can't be repeated in another, and stays out.
3. The other segments are dealt out by minimizer and sorted. Equal segments
   are one; all but those of the smallest document are removed at once. If a
   minimizer has no other segment, that settles it.
4. Of the other distinct segments those windows stay whose hash two documents
   have; neighbours among them are one piece. Equal pieces are one, as segments
   are: at the end of a passage all have the same piece, whatever follows it.
5. The distinct pieces of a task become one string, and its suffixes are
   sorted by the difference-cover algorithm: the triples that start at
   positions 1 and 2 modulo 3 are sorted and named, the string of names is
   sorted by recursion, the remaining suffixes are sorted by their first byte
   and the rank that follows, and both are merged. Windows that are equal are
   then neighbours: adjacent 50-byte prefixes are compared, and the smallest
   document of each class of equal windows decides.
6. A minimizer whose distinct pieces are more than RUN_BYTES, or whose distinct
   segments are more than HELD_BYTES, is not settled in one task: they go out
   again, cut into their windows. Equal windows are grouped by their bytes, the
   smallest document of each is taken by partial aggregation, and windows of
   other documents are found by a join.
7. The spans go back to their documents and are cut out.

A task holds the distinct segments of a minimizer, not its occurrences, and of
one minimizer HELD_BYTES at most: the inside of a passage that very many
documents share is a few segments, however often it occurs, and the ends of such
a passage, one segment for each document, are a few pieces.

Defined results: a null or short text loses nothing. Rows that repeat a doc_id
are one document to the others: they take nothing from each other. A row
without a doc_id is smaller than none: it loses nothing and takes nothing
away. Matches never cross documents; a string repeated only inside one stays.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keep, slices, utf8

LENGTH, SEED = 50, 24
#: Windows that one segment holds at most.
MOST_WINDOWS = 4096
#: Minimizers that a bucket holds on average, and bytes of distinct pieces sorted at once.
BUCKET_ANCHORS, SORT_BYTES = 1_000_000, 100_000
#: Bytes of segments that are compared by their windows' hashes at once, if no minimizer has more.
GATHERED_BYTES = 1_000_000
#: Bytes of one minimizer's distinct segments, and of its distinct pieces, that a task holds; beyond that they are dealt out by window.
HELD_BYTES, RUN_BYTES = 2_000_000, 500_000
#: Bytes of segments that are cut into windows at once; each gives some twenty windows.
WINDOW_SLICE = 200_000
#: Minimizers that a task gathers before it deals them out.
HELD_ANCHORS = 500_000
SPANS = "array<struct<version:bigint,start:bigint,length:bigint>>"
_BITS = 40


def _each(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """count[i] numbers from first[i] on, for each i in turn, and their i."""
    of = np.repeat(np.arange(len(count)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of], of


def _order(key: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of values from 0 to below 2**bits."""
    place = len(key).bit_length()
    if bits + place > 64:
        return np.argsort(key, kind="stable")
    both = key.astype(np.uint64) << np.uint64(place) | np.arange(len(key), dtype=np.uint64)  # sorting values is faster than sorting places
    both.sort()
    return (both & np.uint64((1 << place) - 1)).astype(np.int64)


# -- the suffix array ---------------------------------------------------------

def _names(columns: list[np.ndarray]) -> np.ndarray:
    """Dense names from 1, in the order of the rows (columns[0] first)."""
    sizes = [int(c.max()) + 1 for c in columns]
    if math.prod(sizes) < 1 << 62:
        key = columns[0]
        for c, size in zip(columns[1:], sizes[1:]):
            key = key * size + c
        order = _order(key, math.prod(sizes).bit_length())
        new = np.append(True, key[order][1:] != key[order][:-1])
    else:
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _below(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """For each row of a the number of rows of b that come before it; both are sorted."""
    key = _names([np.concatenate(c) for c in zip(a, b)])
    return np.searchsorted(key[len(a[0]):], key[:len(a[0])])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (int64, all over 0) in order, by difference cover modulo 3."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    p = np.concatenate([s, np.zeros(3, np.int64)])
    at = np.arange(n + (n % 3 == 1))
    one, two = at[at % 3 == 1], at[at % 3 == 2]
    sample = np.concatenate([one, two])
    names = _names([p[sample], p[sample + 1], p[sample + 2]])
    if names.max() == len(names):
        order = np.argsort(names)
    else:
        order = suffix_array(names)
    sample = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    sample = sample[sample < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(_names([p[rest], rank[rest + 1]]))]
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    place = np.arange(len(rest)) + _below([p[rest], rank[rest + 1]], [p[one], rank[one + 1]]) \
        + _below([p[rest], p[rest + 1], rank[rest + 2]], [p[two], p[two + 1], rank[two + 2]])
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[place] = False
    out[place] = rest
    out[free] = sample
    return out


def repeated_windows(segments: list[bytes], owner: np.ndarray) -> list[np.ndarray]:
    """For each segment which of its windows occur in a segment of a smaller owner too."""
    size = np.array([len(x) for x in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0" * LENGTH, np.uint8)
    total = int(size.sum()) + len(segments)  # with what stands between
    begin = np.cumsum(size + 1) - size - 1
    s = text[:total].astype(np.int64) + 2
    s[begin + size] = 1
    windows = size - LENGTH + 1
    segment = np.repeat(np.arange(len(size)), windows)
    start = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[segment]
    number = np.full(total, -1)
    number[start] = np.arange(len(start))
    order = number[suffix_array(s)]
    order = order[order >= 0]
    new = np.ones(len(order), bool)
    for k in range(1, len(order), 50_000):  # adjacent prefixes
        b = start[order[k - 1:k + 50_000]]
        prefix = text[b[:, None] + np.arange(LENGTH)]
        new[k:k + len(b) - 1] = (prefix[1:] != prefix[:-1]).any(1)
    first = np.minimum.reduceat(owner[segment[order]], np.flatnonzero(new))
    out = np.empty(len(order), bool)
    out[order] = first[np.cumsum(new) - 1] < owner[segment[order]]
    return np.split(out, np.cumsum(windows)[:-1])


# -- minimizers and segments --------------------------------------------------

def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two."""
    h = (a ^ (b << np.uint64(21)) ^ (b >> np.uint64(43))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h


def _hashes(raw: np.ndarray) -> np.ndarray:
    """Hashes of the 8-byte strings."""
    x = raw.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x


def _spread(h: np.ndarray) -> np.ndarray:
    """Minima of hashes are small; these have all first bits alike often, one to one."""
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


def _window_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the window that starts at each byte; len(raw) >= LENGTH."""
    h = _hashes(raw)
    h = _joined(h[:-8], h[8:])
    h = _joined(h[:-16], h[16:])
    return _joined(h[:32 - LENGTH], h[LENGTH - 32:])


def _window_minimizers(raw: np.ndarray) -> np.ndarray:
    """The minimizer of the window that starts at each byte; len(raw) >= LENGTH."""
    h = _hashes(raw)
    h = _joined(_joined(h[:-16], h[8:-8]), h[16:])
    span, width = 1, LENGTH - SEED + 1
    while 2 * span <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < width:
        h = np.minimum(h[:span - width], h[width - span:])
    return h


def _windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, start, text) of all windows inside the texts."""
    if len(raw) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = _window_minimizers(raw)
    count = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    start, text = _each(offsets[:-1], count)
    return h[start], start, text


def _planes(x: np.ndarray, n: int) -> bytes:
    """The lowest n bytes of each value, byte by byte: what is alike in all values compresses well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _values(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(data, np.uint8).reshape(n, -1).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def shared_minimizers(texts: DataFrame, bucket_bits: int) -> DataFrame:
    """(doc_id, minimizers): of each document those that another one has too, by
    the first bucket_bits + 40 bits once they are spread; several rows a document."""
    bits = bucket_bits + _BITS
    shift = np.uint64(64 - bits)

    def dealt(batches):
        hashes, docs, held = [], [], 0

        def rows():
            nonlocal hashes, docs, held
            h, d = np.concatenate(hashes), np.concatenate(docs)
            rest = max(0, bits + len(h).bit_length() - 64)  # by these last bits rows need not be in order
            order = _order(h >> np.uint64(rest), bits - rest)
            h, d = h[order], d[order]
            once = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, bool)
            h, d = h[once], d[once]
            bucket = (h >> np.uint64(_BITS)).astype(np.int64)
            edges = np.flatnonzero(np.diff(bucket, prepend=-1))
            out = [(int(bucket[a]), _planes(h[a:b], 5), _planes(d[a:b].view(np.uint64), 8)) for a, b in zip(edges, [*edges[1:], len(h)])]
            hashes, docs, held = [], [], 0
            if out:
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))],
                                                  ["bucket", "hashes", "docs"])

        for batch in batches:
            ids, done = batch.column(0).to_numpy(), 0
            for raw, offsets in slices(batch.column(1)):
                h, _, text = _windows(raw, offsets)
                new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])) if len(h) else np.zeros(0, bool)
                hashes.append(_spread(h[new]) >> shift)
                docs.append(ids[done + text[new]])
                done += len(offsets) - 1
                held += len(hashes[-1])
                if held >= HELD_ANCHORS and (out := rows()):
                    yield out
        if hashes and (out := rows()):
            yield out
        give_back()

    def shared(batches):
        bucket, parts = None, []

        def rows():
            h = np.concatenate([_values(x, 5) for x, _ in parts])
            d = np.concatenate([_values(x, 8) for _, x in parts]).view(np.int64)
            order = _order(h, _BITS)
            h, d = h[order], d[order]
            new = np.append(True, h[1:] != h[:-1])
            edge = np.flatnonzero(new)
            several = np.logical_or.reduceat(np.append(False, d[1:] != d[:-1]) & ~new, edge)
            stays = np.repeat(several, np.diff(np.append(edge, len(d))))
            h, d = h[stays] | np.uint64(bucket << _BITS), d[stays]
            order = np.argsort(d, kind="stable")
            h, d = h[order].astype("<u8"), d[order]
            edge = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, int)
            ends = np.append(edge[1:], len(d)) if len(d) else edge
            places = pa.array(np.concatenate([[0], 8 * ends]).astype(np.int32))
            values = pa.Array.from_buffers(pa.binary(), len(edge), [None, places.buffers()[1], pa.py_buffer(h)])
            return pa.RecordBatch.from_arrays([pa.array(d[edge]), values], ["doc_id", "minimizers"])

        for batch in batches:
            for b, h, d in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket:
                    if parts:
                        yield rows()
                    bucket, parts = b, []
                parts.append((h, d))
        if parts:
            yield rows()
        give_back()

    buckets = texts.select("doc_id", "text").mapInArrow(dealt, "bucket bigint, hashes binary, docs binary")
    return buckets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(shared, "doc_id bigint, minimizers binary")


def shared_segments(texts: DataFrame, bucket_bits: int) -> DataFrame:
    """(minimizer, segment, doc_id, version, start) from (doc_id, text, version, minimizers)."""
    shift = np.uint64(64 - bucket_bits - _BITS)

    def of(batches):
        for batch in batches:
            ids, versions, done = batch.column(0).to_numpy(), batch.column(2).to_numpy(), 0
            listed = batch.column(3).to_pylist()
            for raw, offsets in slices(batch.column(1)):
                h, start, text = _windows(raw, offsets)
                n = len(offsets) - 1
                # Minimizers of a document that are in its list; text and minimizer are looked up as one hash. Should
                # two of those be equal by chance, a segment too many goes on.
                new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])) if len(h) else np.zeros(0, bool)
                head = np.flatnonzero(new)
                own = [b"".join(x) if x else b"" for x in listed[done:done + n]]
                of = np.repeat(np.arange(n), [len(x) // 8 for x in own])
                known = _joined(np.frombuffer(b"".join(own), "<u8").astype(np.uint64), of.astype(np.uint64))
                m = _spread(h[head]) >> shift
                found = pc.is_in(pa.array(_joined(m, text[head].astype(np.uint64))), pa.array(known)).to_numpy(zero_copy_only=False)
                shared = np.repeat(found, np.diff(np.append(head, len(h))))
                h, start, text = h[shared], start[shared], text[shared]
                if len(h):
                    new = np.append(True, (h[1:] != h[:-1]) | (start[1:] != start[:-1] + 1) | (text[1:] != text[:-1]))
                    first = np.flatnonzero(new)
                    place = np.arange(len(h)) - first[np.cumsum(new) - 1]
                    first = np.flatnonzero(place % MOST_WINDOWS == 0)
                    a, t = start[first], text[first]
                    b = start[np.append(first[1:], len(h)) - 1] + LENGTH
                    data = raw.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((_spread(h[first]) >> shift).view(np.int64)), pa.array([data[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary()),
                         pa.array(ids[done + t]), pa.array(versions[done + t]), pa.array(a - offsets[t])],
                        ["minimizer", "segment", "doc_id", "version", "start"])
                done += n
        give_back()

    return texts.select("doc_id", "text", "version", "minimizers").mapInArrow(
        of, "minimizer bigint, segment binary, doc_id bigint, version bigint, start bigint")


def repeated_spans(minimizers: np.ndarray, segments: pa.Array, docs: np.ndarray, compare=repeated_windows, sort_bytes: int = SORT_BYTES,
                   run_bytes: int = RUN_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(row, start, length, piece) from rows in the order of minimizer, segment and
    doc_id, where each segment has rows of one document: what is in a smaller
    document too, where piece is None; else a piece that is yet to be compared by its
    windows, since its minimizer has more than run_bytes."""
    new = np.ones(len(docs), bool)
    new[1:] = (minimizers[1:] != minimizers[:-1]) | pc.not_equal(segments.slice(1), segments.slice(0, len(docs) - 1)).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    rows, owner, run = np.diff(np.append(first, len(docs))), docs[first], minimizers[first]
    raw, offsets = utf8(segments.take(pa.array(first)))
    start, segment = _each(offsets[:-1], np.diff(offsets) - LENGTH + 1)
    # Windows whose hash two documents have, by as many of its bits as leave room for the window's number.
    h = _window_hashes(raw)[start]
    bits = 64 - len(h).bit_length()
    h >>= np.uint64(64 - bits)
    order = _order(h, bits)
    edge = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
    of = owner[segment[order]]
    several = np.minimum.reduceat(of, edge) < np.maximum.reduceat(of, edge)
    stays = np.zeros(len(h), bool)
    stays[order] = np.repeat(several, np.diff(np.append(edge, len(h))))
    at = np.flatnonzero(stays)
    if not len(at):
        return at, at, at, []
    begins = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (segment[at[1:]] != segment[at[:-1]])))
    begin, windows = start[at[begins]], np.diff(np.append(begins, len(at)))
    segment = segment[at[begins]]
    # Equal pieces are one.
    data, number = raw.tobytes(), {}
    piece = np.array([number.setdefault(data[a:b], len(number)) for a, b in zip(begin.tolist(), (begin + windows + LENGTH - 1).tolist())])
    distinct = list(number)
    size = np.array([len(x) for x in distinct])
    smallest = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(smallest, piece, owner[segment])
    whole = owner[segment] > smallest[piece]
    # Pieces of a minimizer are neighbours, since rows come by minimizer.
    own_run = np.zeros(len(distinct), np.int64)
    own_run[piece] = run[segment]
    edge = np.flatnonzero(np.append(True, own_run[1:] != own_run[:-1]))
    count, total = np.diff(np.append(edge, len(distinct))), np.add.reduceat(size, edge)
    beyond = np.repeat((total > run_bytes) & (count > 1), count)
    total[(count == 1) | (total > run_bytes)] = 0  # an only piece has nothing to be compared with
    chunk = np.repeat(np.where(total > 0, (np.cumsum(total) - total) // sort_bytes, -1), count)
    to_sort = np.flatnonzero(chunk >= 0)
    masks = []
    for group in np.split(to_sort, np.flatnonzero(np.diff(chunk[to_sort])) + 1) if len(to_sort) else []:
        for mask in compare([distinct[k] for k in group], smallest[group]):
            masks += [mask, [False]]
    # Spans of the pieces that were sorted.
    flat = np.concatenate([[False], *masks]).astype(np.int8)
    a, b = np.flatnonzero(np.diff(flat) == 1), np.flatnonzero(np.diff(flat) == -1)
    ends = np.cumsum(size[to_sort] - LENGTH + 2)
    mine = np.searchsorted(ends, a, "right")
    a, length = a - (ends - size[to_sort] + LENGTH - 2)[mine], b - a + LENGTH - 1
    found = np.bincount(to_sort[mine], minlength=len(distinct))
    # Those of all pieces, then of all rows.
    each, of = _each((np.cumsum(found) - found)[piece], np.where(whole, 0, found[piece]))
    gone, given = np.flatnonzero(whole), np.flatnonzero(beyond[piece] & ~whole)
    of, inside, length = np.concatenate([of, gone, given]), np.concatenate([a[each], 0 * gone, 0 * given]), \
        np.concatenate([length[each], size[piece[gone]], size[piece[given]]])
    inside += (begin - offsets[segment])[of]
    texts = [None] * (len(of) - len(given)) + [distinct[k] for k in piece[given]]
    row, of_span = _each(first[segment[of]], rows[segment[of]])
    return row, inside[of_span], length[of_span], [texts[k] for k in of_span] if len(given) else [None] * len(row)


def removed_spans(segments: DataFrame) -> DataFrame:
    """(doc_id, version, start, length, segment): bytes that a smaller document has
    too, where segment is null; else a piece that is yet to be compared by its
    windows, since its minimizer has too many. Spans may overlap."""
    names = ["doc_id", "version", "start", "length", "segment"]

    def of(batches):
        held, held_bytes = [], 0  # rows of minimizers that may go on
        beyond = None  # a minimizer that has more than HELD_BYTES

        def given_out(rows):
            length = pc.binary_length(rows.column(1)).cast(pa.int64())
            return pa.RecordBatch.from_arrays([rows.column(2), rows.column(3), rows.column(4), length, rows.column(1)], names)

        def settled(last):
            nonlocal held, held_bytes, beyond
            rows = pa.concat_batches(held)
            minimizers = rows.column(0).to_numpy()
            done = len(minimizers) if last else int(np.argmax(minimizers == minimizers[-1]))
            held = [rows.slice(done)]
            if done:
                rows = rows.slice(0, done)
                row, start, length, pieces = repeated_spans(
                    minimizers[:done], rows.column(1), rows.column(2).to_numpy(), repeated_windows, SORT_BYTES, RUN_BYTES)
                if len(row):
                    docs, versions, starts = (rows.column(k).to_numpy()[row] for k in (2, 3, 4))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (docs, versions, starts + start, length)), pa.array(pieces, pa.binary())], names)
            held_bytes = sum(pc.sum(pc.binary_length(x.column(1))).as_py() or 0 for x in held)
            if held_bytes > HELD_BYTES:
                beyond = int(minimizers[-1])
                yield given_out(held[0])
                held, held_bytes = [], 0

        last = None  # minimizer, segment and its first document where the batch before ended
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            # Whole columns at a time: copies of a segment, and minimizers with a single segment.
            minimizers, texts = batch.column(0).to_numpy(), batch.column(1)
            docs = batch.column(2).to_numpy()
            new_run, new = np.ones(n, bool), np.ones(n, bool)
            new_run[1:] = minimizers[1:] != minimizers[:-1]
            new[1:] = new_run[1:] | pc.not_equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            if last is not None and last[0] == minimizers[0]:
                new_run[0], new[0] = False, last[1] != texts[0].as_py()
            at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            firsts = np.where(at >= 0, docs[at], docs[0] if last is None else last[2])
            last = int(minimizers[-1]), texts[n - 1].as_py(), int(firsts[-1])
            whole = np.flatnonzero(docs != firsts)  # rows come in ascending doc_id
            if len(whole):
                length = pc.binary_length(texts).to_numpy()[whole].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(docs[whole]), batch.column(3).take(pa.array(whole)), batch.column(4).take(pa.array(whole)),
                                                  pa.array(length), pa.nulls(len(whole), pa.binary())], names)
            run_of = np.cumsum(new_run) - new_run[0]
            alone = np.bincount(run_of, new) == 1
            alone[[0, -1]] = False  # may go on in another batch
            stays = (docs == firsts) & ~alone[run_of]
            if beyond is not None:
                more = minimizers == beyond
                if (more & stays).any():
                    yield given_out(batch.take(pa.array(np.flatnonzero(more & stays))))
                if not more[-1]:
                    beyond = None
                stays &= ~more
            if stays.any():
                held.append(batch.take(pa.array(np.flatnonzero(stays))))
                held_bytes += pc.sum(pc.binary_length(held[-1].column(1))).as_py()
                if held_bytes > GATHERED_BYTES:
                    yield from settled(False)
        if held:
            yield from settled(True)
        give_back()

    return segments.repartition("minimizer").sortWithinPartitions("minimizer", "segment", "doc_id") \
        .mapInArrow(of, "doc_id bigint, version bigint, start bigint, length bigint, segment binary")


def spans_of_windows(removed: DataFrame) -> DataFrame:
    """(doc_id, version, start, length) of the windows of ``removed``'s segments
    that are in a segment of a smaller document too."""
    def of(batches):
        for batch in batches:
            batch = batch.filter(batch.column(4).is_valid())
            done = 0
            for raw, offsets in slices(batch.column(4), WINDOW_SLICE):
                windows = np.diff(offsets) - LENGTH + 1
                row = np.repeat(np.arange(len(windows)), windows)
                place = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                data = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[offsets[row] + place]  # a copy of LENGTH bytes a row, no more
                ends = pa.array(np.arange(len(row) + 1, dtype=np.int32) * LENGTH)
                window = pa.Array.from_buffers(pa.binary(), len(row), [None, ends.buffers()[1], pa.py_buffer(data)])
                ids, versions, start = (batch.column(k).to_numpy()[done + row] for k in range(3))
                yield pa.RecordBatch.from_arrays([window, pa.array(ids), pa.array(versions), pa.array(start + place)],
                                                 ["window", "doc_id", "version", "start"])
                done += len(windows)
        give_back()

    windows = removed.mapInArrow(of, "window binary, doc_id bigint, version bigint, start bigint")
    firsts = windows.groupBy(F.col("window").alias("same")).agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")) \
        .where("first_doc < last_doc").select("same", "first_doc")
    return windows.join(firsts, F.col("window") == F.col("same")).where("doc_id > first_doc") \
        .select("doc_id", "version", "start", F.lit(LENGTH).cast("bigint").alias("length"))


def cut(texts: pa.Array, copy: pa.Array, version: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without their spans, copies without anything: (kept, n_bytes, n_removed, n_spans)."""
    kept, n_bytes, n_removed, n_spans = [], [], [], []
    for text, gone_whole, own, found in zip(texts, copy, version, spans):
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        n = len(data)
        runs = 0
        if gone_whole.as_py() and n >= LENGTH:
            data, runs = b"", 1
        elif found.is_valid and len(found):
            values = found.values.flatten()  # version, start, length
            mine = values[0].to_numpy() == own.as_py()
            start, length = values[1].to_numpy()[mine], values[2].to_numpy()[mine]
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
            data = np.frombuffer(data, np.uint8)[~gone].tobytes()
        kept.append(data)
        n_bytes.append(n)
        n_removed.append(n - len(data))
        n_spans.append(runs)
    return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans))],
                                      ["kept", "n_bytes", "n_removed", "n_spans"])


def suffix_dedup(docs: DataFrame, out: str = "suffix_dedup") -> DataFrame:
    """doc_id and a struct column ``out`` for each row of ``docs``: kept (binary),
    n_bytes, n_removed, n_spans (maximal removed runs)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    density = 2 / (LENGTH - SEED + 2)
    bucket_bits = max(6, math.ceil(math.log2(max(1, total * density / BUCKET_ANCHORS))))
    id_type = docs.schema["doc_id"].dataType
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Of each text its first document; version tells texts of one doc_id apart.
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("content")
    contents = keep(rows.select("doc_id", digest).groupBy("content").agg(F.min("doc_id").alias("first_id")), "contents")
    firsts = contents.groupBy("first_id").agg(F.sort_array(F.collect_list("content")).alias("contents"))
    # All that follows reads the texts from one exchange, so every join is on doc_id alone.
    texts = rows.select("doc_id", "text", digest).repartition("doc_id")
    place = F.coalesce(F.array_position("contents", F.col("content")), F.lit(0))
    known = texts.join(firsts.hint("shuffle_hash"), F.col("doc_id") == F.col("first_id"), "left") \
        .select("doc_id", "text", F.when(place > 0, place).alias("version"))
    own = known.where("version is not null")
    listed = shared_minimizers(own, bucket_bits).groupBy(F.col("doc_id").alias("listed_id")).agg(F.collect_list("minimizers").alias("minimizers"))
    segments = shared_segments(own.join(listed.hint("shuffle_hash"), F.col("doc_id") == F.col("listed_id")), bucket_bits)
    # Read by both branches from one exchange; the filter stands before it, since one that is inferred later would make two.
    removed = removed_spans(segments).where("doc_id is not null").repartition("doc_id")
    span = F.struct("version", "start", "length")
    spans = removed.groupBy(F.col("doc_id").alias("span_id")).agg(F.collect_list(F.when(F.col("segment").isNull(), span)).alias("spans"))
    more = spans_of_windows(removed).groupBy(F.col("doc_id").alias("more_id")).agg(F.collect_list(span).alias("more_spans"))
    result = F.arrow_udf(cut, "struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>")
    found = known.join(spans.hint("shuffle_hash"), F.col("doc_id") == F.col("span_id"), "left") \
        .join(more.hint("shuffle_hash"), F.col("doc_id") == F.col("more_id"), "left")
    every = F.concat(F.coalesce("spans", F.array().cast(SPANS)), F.coalesce("more_spans", F.array().cast(SPANS)))
    nothing = F.lit(None).cast(SPANS)
    return found.select(F.col("doc_id").cast(id_type).alias("doc_id"), result("text", F.col("version").isNull(), F.coalesce("version", F.lit(0)), every).alias(out)) \
        .unionByName(docs.where("doc_id is null").select("doc_id", result("text", F.lit(False), F.lit(0).cast("bigint"), nothing).alias(out)))
