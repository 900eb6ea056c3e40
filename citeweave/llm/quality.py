"""Quality scores by Bradley-Terry pairwise ranking.

A document is a vector of byte and byte-pair shares and a few scalars. Every
pair of a better and a worse labelled document is a match, and the logistic
loss on the difference of their strengths, summed over all pairs, is brought
down by L-BFGS: the Bradley-Terry model with a linear strength. No pair is
written out: a document's chance to lose against the other kind follows from
the other kind's counts by strength (in steps of STEP), so a round is two
passes over the labelled rows' kept vectors, one that counts strengths and one
that sums the vectors by those chances. The cut between accepted and rejected
documents is a quantile of all labelled strengths: the share of worse documents
among the labels. Scores are strengths through a logistic function that puts
the cut at 0.7. Sums are of integers, so the model doesn't depend on how rows
are dealt to tasks.

Scoring is a map over the rows: nothing is shuffled. Defined results: a null
text counts as empty; without labels of both kinds every document gets score
1 (nothing is known against it). Repeated rows get equal scores; labels that
contradict each other both count.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import keep, utf8

#: Rounds of the fit, earlier steps that a round looks at, weight of the squared norm.
ROUNDS, MEMORY, RIDGE = 12, 8, 1e-2
#: Strengths are counted in steps of this width, those beyond BINS / 2 steps in the last one.
STEP, BINS = 1 / 64, 8192
#: Vectors are summed as multiples of 1 / FIXED.
FIXED = float(1 << 28)
CUT = 0.7
PAIR_BINS = 1024
SCALARS = 4
#: Bytes added to a text's length, so that a short text's shares say less.
SHRINK = 64
WIDTH = 256 + PAIR_BINS + SCALARS
_GUARD = np.float32(1e-3)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of WIDTH floats for each text."""
    out = np.zeros((len(offsets) - 1, WIDTH), np.float32)
    pair = (raw[:-1].astype(np.uint16) * np.uint16(40503) + raw[1:].astype(np.uint16) * np.uint16(9973)) >> np.uint16(6)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        n = b - a
        if not n:
            out[i, -1] = 1
            continue
        own = raw[a:b]
        out[i, :256] = np.sqrt(np.bincount(own, minlength=256) / (n + SHRINK))
        if n > 1:
            out[i, 256:256 + PAIR_BINS] = np.sqrt(np.bincount(pair[a:b - 1], minlength=PAIR_BINS) / (n + SHRINK))
        out[i, -4] = np.log1p(n) / 10
        out[i, -3] = len(zlib.compress(own, 1)) / (n + 20)  # repetition
        out[i, -2] = np.count_nonzero((own == 10) | (own == 32)) / n * 3
    return out


@dataclass
class Model:
    weights: np.ndarray
    cut: float
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (x @ self.weights - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: Sums a function of (vectors, which are labelled 1) over all labelled rows; it returns this many integers for some of them.
Total = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray], int], np.ndarray]


def _counted(at: np.ndarray, better: np.ndarray, bins: int) -> np.ndarray:
    return np.bincount(at + bins * better, minlength=2 * bins)


def _bins(s: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(s / STEP), -BINS // 2, BINS // 2 - 1).astype(np.int64) + BINS // 2


def _moments(x: np.ndarray, better: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    whole = [np.rint(v * FIXED).astype(np.int64).sum(0) for v in (x, x * x)]
    return np.concatenate([*whole, [np.count_nonzero(~better), np.count_nonzero(better)]])


def _against(mine: np.ndarray, other: np.ndarray, sign: int, of: Callable) -> np.ndarray:
    """For each strength that ``mine`` counts, the mean over ``other`` of ``of`` the other's lead (times ``sign``)."""
    out, theirs = np.zeros(BINS), np.flatnonzero(other)
    for k in np.array_split(np.flatnonzero(mine), 32):
        out[k] = of(sign * STEP * (theirs[None] - k[:, None])) @ other[theirs] / other.sum()
    return out


def _chance(lead: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(lead, -40, 40)))


def _fit(total: Total, width: int, worse_share: float) -> Model | None:
    found = total(_moments, 2 * width + 2)
    n_bad, n_good = found[-2:]
    if not n_bad or not n_good:
        return None
    mean = found[:width] / FIXED / (n_bad + n_good)
    spread = np.sqrt(np.maximum(found[width:-2] / FIXED / (n_bad + n_good) - mean * mean, 0)) + _GUARD

    def strengths(w):
        """(counts of label 0, of label 1) by strength."""
        v = w / spread
        m = mean @ v
        counts = total(lambda x, better: _counted(_bins(x @ v - m), better, BINS), 2 * BINS)
        return counts[:BINS], counts[BINS:]

    def loss(w, bad, good):
        return _against(good, bad, 1, lambda lead: np.logaddexp(0, lead)) @ good / n_good + RIDGE / 2 * (w @ w)

    def gradient(w, bad, good):
        v = w / spread
        m = mean @ v
        lost = _against(good, bad, 1, _chance)  # a better document's chance to lose
        won = _against(bad, good, -1, _chance)  # a worse one's to win

        def sums(x, better):
            at = _bins(x @ v - m)
            part = np.rint(x * (np.where(better, lost[at], won[at]) * FIXED)[:, None]).astype(np.int64)
            return np.concatenate([part[~better].sum(0), part[better].sum(0)])

        s = total(sums, 2 * width) / FIXED
        return (s[:width] / n_bad - s[width:] / n_good) / spread + RIDGE * w

    w = np.zeros(width)
    counts = strengths(w)
    now, g = loss(w, *counts), gradient(w, *counts)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        if not g.any():
            break
        d, kept = -g, []
        for ds, dg in reversed(steps):
            k = ds @ d / (ds @ dg)
            kept.append(k)
            d = d - k * dg
        if steps:
            ds, dg = steps[-1]
            d = d * (ds @ dg / (dg @ dg))
        else:
            d = d / (np.linalg.norm(g) * np.sqrt(width))
        for (ds, dg), k in zip(steps, reversed(kept)):
            d = d + (k - dg @ d / (ds @ dg)) * ds
        rate = 1.0
        for _ in range(10):
            counts = strengths(w + rate * d)
            new = loss(w + rate * d, *counts)
            if new < now + 1e-4 * rate * (g @ d):
                break
            rate /= 2
        else:
            break
        new_g = gradient(w + rate * d, *counts)
        if rate * d @ (new_g - g) > 1e-12:
            steps = [*steps, (rate * d, new_g - g)][-MEMORY:]
        w, now, g = w + rate * d, new, new_g

    bad, good = strengths(w)
    gap = abs(_middle(good) - _middle(bad)) * STEP
    v = w / spread
    m = float(mean @ v)
    def place(share):
        """(low, high, weight up to high): where the labels, each kind weighted by its share,
        reach ``share`` in the order of strength. The step that holds it is divided until it
        is far narrower than rows are apart."""
        low, step, below, (b, g) = -BINS / 2 * STEP, STEP, 0.0, (bad, good)
        for last in (False, False, True):
            weight = below + np.cumsum(b * (worse_share / n_bad) + g * ((1 - worse_share) / n_good))
            k = min(int(np.searchsorted(weight, share)), BINS - 1)
            below, low = weight[k - 1] if k else below, low + k * step
            if last:
                return low, low + step, weight[k]

            def inside(x, better, low=low, step=step):
                at = np.floor((x @ v - m - low) / (step / BINS)).astype(np.int64)
                here = (at >= 0) & (at < BINS)
                return _counted(at[here], better[here], BINS)

            found = total(inside, 2 * BINS)
            b, g, step = found[:BINS], found[BINS:], step / BINS

    # The cut is halfway from the quantile to the next strength.
    _, cut, reached = place(worse_share - 1e-9)
    if reached < 1 - 1e-9:
        cut = (cut + place(reached + 1e-10)[0]) / 2
    return Model(v, float(cut + m), float(6 / max(gap, STEP)))


def _middle(counts: np.ndarray) -> int:
    return int(np.searchsorted(np.cumsum(counts), counts.sum() / 2))


def fit(x: np.ndarray, better: np.ndarray, worse_share: float) -> Model | None:
    """x: rows of features; better: which of them are labelled 1; worse_share: of
    label 0 among all labels, which the rows need not keep."""
    return _fit(lambda f, n: f(x, better).astype(np.float64), x.shape[1], worse_share)


#: A vector as it is kept: a bit for each count that is not 0, the counts up to 255, those
#: from 255 on, and the scalars. Shares are taken from the counts when it is read.
PACKED = "bits binary, counts binary, large binary, length bigint, scalars binary"


def packed(raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """The columns PACKED of each text."""
    n = np.diff(offsets)
    x = features(raw, offsets)
    counts = np.rint(x[:, :-SCALARS].astype(np.float64) ** 2 * (n + SHRINK)[:, None]).astype(np.uint32)
    some = counts > 0
    flat = counts[some]
    large = flat >= 255
    owner = np.nonzero(some)[0]
    bits = np.packbits(some, 1)

    def rows(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])

    return [rows(bits, np.full(len(n), bits.shape[1])), rows(np.minimum(flat, 255).astype(np.uint8), some.sum(1)),
            rows(flat[large].astype("<u4"), 4 * np.bincount(owner[large], minlength=len(n))), pa.array(n, pa.int64()),
            rows(x[:, -SCALARS:], np.full(len(n), 4 * SCALARS))]


def unpacked(columns: list[pa.Array]) -> np.ndarray:
    """``features`` of the texts that ``packed`` took."""
    bits, counts, large, length, scalars = columns
    n = length.to_numpy(zero_copy_only=False)
    some = np.unpackbits(utf8(bits)[0].reshape(len(n), -1), axis=1).astype(bool)
    flat = utf8(counts)[0].astype(np.float64)
    flat[flat == 255] = np.frombuffer(utf8(large)[0].tobytes(), "<u4")
    out = np.zeros((len(n), WIDTH), np.float32)
    out[:, :-SCALARS][some] = np.sqrt(flat / np.repeat(n + SHRINK, some.sum(1)))
    out[:, -SCALARS:] = np.frombuffer(utf8(scalars)[0].tobytes(), np.float32).reshape(len(n), SCALARS)
    return out


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on all documents that ``labels`` (doc_id, quality) names; None if one kind
    is missing. Vectors are made where the texts are, so the join with the labels moves no text."""
    labels = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", (F.col("quality") == 1).alias("better"))
    n = {r["better"]: r["count"] for r in labels.groupBy("better").count().collect()}
    if len(n) < 2:
        return None

    def vectors(batches):
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), *packed(*utf8(part.column(1)))], ["doc_id", *[c.split()[0] for c in PACKED.split(", ")]])

    doc_id = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    kept = keep(docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(vectors, f"doc_id {doc_id}, {PACKED}")
                .join(labels, "doc_id").drop("doc_id"), "quality-vectors")

    def total(of, length):
        def sums(batches):
            out = np.zeros(length, np.int64)
            for batch in batches:
                for a in range(0, len(batch), 256):
                    part = batch.slice(a, 256)
                    better = part.column(5).to_numpy(zero_copy_only=False).astype(bool)
                    out += of(unpacked(part.columns[:5]), better)
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(out[at])], ["at", "total"])

        out = np.zeros(length)
        summed = kept.mapInArrow(sums, "at int, total bigint").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        for at, value in summed.collect():  # a row for each feature or step of strength
            out[at] = float(value)
        return out

    return _fit(total, WIDTH, n[False] / (n[False] + n[True]))


def score(text: Column, model: Model | None) -> Column:
    """0 to 1, higher: better; accepted from CUT on."""
    def of(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.ones(len(texts)))
        raw, offsets = utf8(texts)
        out = [model.scores(features(raw[offsets[a]:offsets[min(a + 256, len(texts))]], offsets[a:a + 257] - offsets[a]))
               for a in range(0, len(texts), 256)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))
    return F.arrow_udf(of, "double")(text)
