"""Toxicity by FTRL-proximal logistic regression.

Features of a document are the presence of its word unigrams, bigrams and skip-grams (word
pairs with one or two words between them), hashed to ``2**bits`` coordinates. The
follow-the-regularised-leader update keeps a learning rate for each coordinate, and its L1
term leaves all but the telling coordinates at exactly zero, so the model is a short
list of (coordinate, weight) that is broadcast whatever the corpus size.

Training reads a bounded sample of the labelled rows; scoring is one scan of all whole texts
with no shuffle.

Defined results: a NULL or empty text scores the bias alone; repeated rows score alike; a NULL
``doc_id`` is scored and counts as not held out; an empty table gives no rows; a label table without
usable rows gives 0.5 for every document. Extra columns are ignored.
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

BITS, SKIPS = 20, (1, 2, 3)
SAMPLE_ROWS, SAMPLE_CHARS = 16_000, 20_000
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 6.0, 0.1, 4

_A = np.uint64(0xC2B2AE3D27D4EB4F)


def features(raw: np.ndarray, offs: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document index, coordinate) of words, then of word pairs at each distance of ``SKIPS``."""
    w = tn.Words(raw, offs, tn.ALNUM)
    doc, shift = w.doc(), np.uint64(64 - bits)
    yield doc, (w.hash >> shift).astype(np.int64)
    for gap in SKIPS:
        same = doc[gap:] == doc[:-gap]
        pair = tn.mix(w.hash[:-gap] * _A + w.hash[gap:] + np.uint64(gap))
        yield doc[gap:][same], (pair[same] >> shift).astype(np.int64)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """The nonzero coordinates, their weights, the bias and the size of the feature space."""
    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float32)
        table[self.index] = self.weight
        return table

    def scores(self, raw: np.ndarray, offs: np.ndarray, table: np.ndarray) -> np.ndarray:
        keys = []
        for doc, at in features(raw, offs, self.bits):
            telling = table[at] != 0
            keys.append(doc[telling].astype(np.int64) << self.bits | at[telling])
        once = np.unique(np.concatenate(keys))
        total = np.bincount(once >> self.bits, table[once & ((1 << self.bits) - 1)], len(offs) - 1)
        return sigmoid(total + self.bias)


def train(sample: list[tuple[str, int]], bits: int = BITS, alpha: float = ALPHA, beta: float = BETA,
          l1: float = L1, l2: float = L2, epochs: int = EPOCHS, seed: int = 1) -> Model:
    """FTRL-proximal over the sample; the bias is a coordinate without L1."""
    docs = []
    for text, y in sample:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        at = np.unique(np.concatenate([f for _, f in features(raw, np.array([0, len(raw)]), bits)]))
        docs.append((np.append(at, 1 << bits).astype(np.int32), y))
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    lam = np.full((1 << bits) + 1, l1)
    lam[-1] = 0

    def weights(at):
        over = np.abs(z[at]) - lam[at]
        return np.where(over > 0, -np.sign(z[at]) * over / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            at, y = docs[d]
            w = weights(at)
            g = sigmoid(w.sum()) - y
            root = np.sqrt(n[at])
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / alpha * w
            n[at] += g * g
    w = weights(np.arange((1 << bits) + 1))
    index = np.flatnonzero(w[:-1])
    return Model(index, w[index].astype(np.float32), float(w[-1]), bits)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS,
        **how) -> Model:
    """Train on a bounded sample of the labelled rows that are not held out."""
    return train(training_sample(docs, labels, "toxic", rows, max_chars), **how)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast((model.index, model.weight, model.bias, model.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        table = own.dense()
        for batch in batches:
            raw, offs = tn.utf8(batch.column(1))
            for i, j, r, o in tn.chunks(raw, offs):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(own.scores(r, o, table), pa.float64())],
                    ["doc_id", "score"])

    return (docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score"))
