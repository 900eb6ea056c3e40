"""Language identification by averaged hashed subword embeddings.

A text's letters, lower-cased, with one space for whatever lies between
words, give character n-grams; each is hashed to an embedding. The mean of a
text's embeddings goes through a linear softmax. Embeddings and softmax are
trained by stochastic gradient descent in numpy on a bounded sample; a tenth
of it is held back to calibrate a temperature and the probability below which
a prediction is not accepted.

Prediction is a map over the rows: nothing is shuffled. Defined results: a
null text or one without a letter is ``und`` with score 0; so is every text if
there was nothing to learn from. Repeated rows get equal predictions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.words import LETTER, _classes

UNKNOWN = "und"
GRAMS = (2, 3, 4)
BUCKET_BITS, WIDTH = 14, 16
#: Texts that the fit sees in expectation, in equal parts by language, and the least part.
SAMPLE, LEAST_PART = 2000, 50
EPOCHS, BATCH, RATE = 20, 32, 0.5
#: Share of wrong predictions among the accepted ones of the held-back texts.
ERROR = 0.005
_MIX = np.uint32(0x9E3779B1)
_SLICE = 1_000_000  # code points handled at once


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all n-grams, text of each, whether each text has a letter)."""
    own = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(own).encode("utf-32-le", "replace"), np.uint32)
    text = np.repeat(np.arange(len(own)), np.fromiter(map(len, own), np.int64, len(own)))
    letter = _classes()[points] == LETTER
    some = np.bincount(text[letter], minlength=len(own)) > 0
    stays = letter.copy()
    stays[0] = True
    stays[1:] |= letter[:-1] | (text[1:] != text[:-1])
    points, text = np.where(letter, points, np.uint32(32))[stays], text[stays]
    buckets, owners = [], []
    for n in GRAMS:
        if len(points) < n:
            continue
        h = np.zeros(len(points) - n + 1, np.uint32)
        for k in range(n):
            h = (h ^ points[k:len(points) - n + 1 + k]) * _MIX
            h ^= h >> np.uint32(15)
        inside = text[n - 1:] == text[:len(h)]
        buckets.append((h * _MIX >> np.uint32(32 - BUCKET_BITS))[inside])
        owners.append(text[:len(h)][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), some
    return np.concatenate(buckets), np.concatenate(owners), some


@dataclass
class Model:
    names: list[str]
    logits: np.ndarray  # of a bucket: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    least: float  # accepted from this probability on

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the name, probability, whether there is a letter)."""
        bucket, owner, some = grams(texts)
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        z = np.stack([np.bincount(owner, self.logits[bucket, k], len(texts)) for k in range(len(self.names))], 1)
        p = softmax((z / n[:, None] + self.bias) / self.temperature)
        return p.argmax(1), p.max(1), some


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: list[tuple[bytes, bytes]], labels: list[str], seed: int = 1) -> Model:
    """rows: (buckets as uint16, their shares as float32) of each text."""
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    x = np.zeros((len(rows), 1 << BUCKET_BITS), np.float32)
    for i, (bucket, share) in enumerate(rows):
        x[i, np.frombuffer(bucket, np.uint16)] = np.frombuffer(share, np.float32)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    back, train = order[:len(x) // 10], order[len(x) // 10:]
    emb = rng.normal(0, 0.1, (x.shape[1], WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, len(names))).astype(np.float32), np.zeros(len(names), np.float32)
    scale = np.float32(np.sqrt(x.shape[1]))  # shares are small: as if they were unit vectors
    for epoch in range(EPOCHS):
        rng.shuffle(train)
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        for k in range(0, len(train), BATCH):
            b = train[k:k + BATCH]
            mean = x[b] @ emb
            d = softmax(mean @ out * scale + bias)
            d[np.arange(len(b)), y[b]] -= 1
            d /= len(b)
            back_d = d @ out.T
            out -= rate * scale * (mean.T @ d) / 10
            bias -= rate * d.sum(0) / 10
            emb -= rate * scale * (x[b].T @ back_d)
    model = Model(names, (emb @ out * scale).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    z = x[back].astype(np.float64) @ model.logits + model.bias
    if len(back):
        grid = np.geomspace(1, 20, 40)  # never more certain than the fit itself
        loss = [-np.log(softmax(z / t)[np.arange(len(back)), y[back]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / model.temperature)
        by = np.argsort(-p.max(1), kind="stable")
        wrong = np.cumsum(p.argmax(1)[by] != y[back][by]) / np.arange(1, len(by) + 1)
        fine = np.flatnonzero(wrong <= ERROR)
        model.least = float(p.max(1)[by][fine[-1]]) if len(fine) else 1.0
    return model


def train(docs: DataFrame) -> Model | None:
    """Fit on (doc_id, text, lang) rows; None without a language. About SAMPLE texts,
    chosen by id hash in equal parts by language, reach the driver as n-gram shares."""
    docs = docs.where("lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not counts:
        return None
    part = max(LEAST_PART, SAMPLE // len(counts))
    share = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(min(1.0, part / n)))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)

    def vectors(batches):
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bucket, _, some = grams([text or ""])
                if some[0]:
                    found, n = np.unique(bucket, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "bucket": [found.astype(np.uint16).tobytes()],
                                                      "share": [(n / n.sum()).astype(np.float32).tobytes()]})

    rows = docs.where(place < share[F.col("lang")]).select("text", "lang") \
        .mapInArrow(vectors, "lang string, bucket binary, share binary").limit(4 * part * len(counts)).collect()
    return fit([(r["bucket"], r["share"]) for r in rows], [r["lang"] for r in rows]) if rows else None


def predict(text: Column, model: Model | None) -> Column:
    """struct<lang:string,score:double,accepted:boolean>."""
    def of(texts: pa.Array) -> pa.Array:
        name, score, accepted = [], [], []
        own = [t or "" for t in texts.to_pylist()]
        a = 0
        while a < len(own):
            b, size = a, 0
            while b < len(own) and (b == a or size + len(own[b]) <= _SLICE):
                size += len(own[b])
                b += 1
            if model is None:
                best, p, some = np.zeros(b - a, int), np.zeros(b - a), np.zeros(b - a, bool)
            else:
                best, p, some = model.predict(own[a:b])
            name += [model.names[k] if s else UNKNOWN for k, s in zip(best, some)]
            score += np.where(some, p, 0.0).tolist()
            accepted += (some & (p >= (model.least if model else 2))).tolist()
            a = b
        return pa.StructArray.from_arrays([pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                                          ["lang", "score", "accepted"])
    return F.arrow_udf(of, "struct<lang:string,score:double,accepted:boolean>")(text)
