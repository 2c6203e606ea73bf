"""Quality classifier with supervised subword embeddings.

Features of a document are its words and the character n-grams (``NGRAMS``) of its
words, white space marking their ends, and a mark for each word that repeats the one before it, hashed to ``2**bits`` rows of a learned
embedding table. The document vector is the mean of its feature vectors; a linear
layer and softmax give the class probabilities. Embeddings and layer are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled rows.

Mean and linear layer commute, so for scoring the model folds to one number for each
bucket (the difference of the two class logits), a table of fixed size that
is broadcast. Scoring is one scan with no shuffle; every whole text is scored.

Defined results: a NULL or empty text has no feature and scores the bias alone; repeated
rows score alike; a NULL ``doc_id`` is scored and counts as not held out; an empty
table gives no rows. Labels other than 0 and 1 and rows with a NULL id are not learned from; a label table
without usable rows gives the prior 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import held_out, training_sample

NGRAMS = (3, 4)
BITS, DIM = 18, 16
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 20_000
EPOCHS, RATE = 6, 40.0

#: The bucket that stands for "the same word again", whatever the word.
AGAIN = 0

_C = np.uint32(0x9E3779B1)


def _code_points(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with a line feed before and after each document, and document starts."""
    data = raw.tobytes()
    text = "\n" + "\n".join([data[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:])]) + "\n"
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.diff(np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offs])
    return cp, np.concatenate([[0], np.cumsum(lengths + 1)]) + 1


def features(raw: np.ndarray, offs: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: (document index in order, bucket)."""
    w = tn.Words(raw, offs, tn.NOT_SPACE, fold=False)
    doc = w.doc()
    yield doc, (w.hash >> np.uint64(64 - bits)).astype(np.int64)
    again = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])) + 1
    yield doc[again], np.full(len(again), AGAIN, np.int64)
    cp, starts = _code_points(raw, offs)
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    seen = np.concatenate([[0], np.cumsum(space)])
    folded = np.where(space, np.uint32(32), cp) + np.uint32(1)
    for n in NGRAMS:
        m = len(cp) - n + 1
        if m <= 0:
            continue
        h = np.full(m, np.uint32(n), np.uint32)
        for i in range(n):
            h *= _C
            h += folded[i:i + m]
            h ^= h >> np.uint32(15)
        at = np.flatnonzero(seen[n - 1:n - 1 + m] == seen[1:1 + m])  # no white space inside
        h = h[at] * np.uint32(0x85EBCA6B)
        yield np.searchsorted(starts, at + 1, "right") - 1, (h >> np.uint32(32 - bits)).astype(np.int64)


@dataclass
class Model:
    """Folded scorer: logit difference of each bucket, and the bias."""
    weight: np.ndarray
    bias: float

    def scores(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        docs = len(offs) - 1
        total, count = np.zeros(docs), np.zeros(docs)
        bits = int(len(self.weight)).bit_length() - 1
        for doc, bucket in features(raw, offs, bits):
            total += np.bincount(doc, self.weight[bucket], docs)
            count += np.bincount(doc, minlength=docs)
        z = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(sample: list[tuple[str, int]], bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 1) -> Model:
    """Stochastic gradient descent, one document a step, with a linearly falling rate."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    docs = []
    for text, y in sample:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        bucket = np.concatenate([b for _, b in features(raw, np.array([0, len(raw)]), bits)])
        rows, n = np.unique(bucket, return_counts=True)
        docs.append((rows, (n / max(1, n.sum())).astype(np.float32), y))
    step, steps = 0, max(1, epochs * len(docs))
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            rows, share, y = docs[d]
            r = rate * (1 - step / steps)
            step += 1
            mean = share @ table[rows]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ layer
            layer -= np.float32(r * 0.05) * np.outer(p, mean)
            bias -= np.float32(r * 0.0005) * p
            table[rows] -= np.float32(r) * share[:, None] * back
    return Model((table @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS,
        **how) -> Model:
    """Train on a bounded sample of the labelled rows that are not held out."""
    return train(training_sample(docs, labels, "quality", rows, max_chars), **how)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(own.scores(r, o), pa.float64())],
                    ["doc_id", "score"])

    return (docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score"))


def keep(docs: DataFrame, model: Model, cut: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``cut``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            raw, offs = tn.utf8(batch.column(at))
            good = [own.scores(r, o) >= cut for _, _, r, o in tn.chunks(raw, offs)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)
