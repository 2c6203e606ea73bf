"""Ops 1 and 8 against plain versions: features word by word, training in dictionaries, scores document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from histwright.llm import quality, textnum as tn, toxicity

M32, M64 = 2**32 - 1, 2**64 - 1
WORDS = ["good", "bad", "Ünï", "漢字", "a", "an", "the", "word", "Word", "x1", "good", "!!", "\U0001f600"]


def corpus(seed, n=40):
    rnd = random.Random(seed)
    texts = [rnd.choice(["", " "]) + rnd.choice([" ", "\n", "  "]).join(rnd.choices(WORDS, k=rnd.randint(1, 25)))
             for _ in range(n)]
    return [(t, int("good" in t.lower()) if rnd.random() < 0.9 else rnd.randint(0, 1)) for t in texts + ["", "good good"]]


def word_hash(word, kind, fold):
    """The shared hash of one word alone."""
    raw, offs = tn.utf8(pa.array([word]))
    w = tn.Words(raw, offs, kind, fold=fold)
    assert len(w) == 1
    return int(w.hash[0])


def logistic(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def scores(model, texts, *extra):
    raw, offs = tn.utf8(pa.array(texts))
    return model.scores(raw, offs, *extra)


# --- op 1 --------------------------------------------------------------------------------------

def quality_features(text, bits):
    out, before = Counter(), None
    for word in re.findall(r"[^ \t-\r]+", text):
        h = word_hash(word, tn.NOT_SPACE, False)
        out[h >> (64 - bits)] += 1
        out[quality.AGAIN] += int(h == before)
        before = h
    marked = re.sub(r"[ \t-\r]", " ", f"\n{text}\n")
    for n in quality.NGRAMS:
        for i in range(len(marked) - n + 1):
            gram = marked[i:i + n]
            if " " in gram[1:-1]:
                continue  # white space only marks an end
            h = n
            for c in gram:
                h = (h * 0x9E3779B1 + ord(c) + 1) & M32
                h ^= h >> 15
            out[((h * 0x85EBCA6B) & M32) >> (32 - bits)] += 1
    return +out


def plain_sgd(sample, bits, dim, epochs, rate, seed):
    rng = np.random.default_rng(seed)
    start = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    table = [[float(x) for x in row] for row in start]
    layer, bias = [[0.0] * dim for _ in range(2)], [0.0, 0.0]
    docs, step = [(quality_features(t, bits), y) for t, y in sample], 0
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            found, y = docs[d]
            total = max(1, sum(found.values()))
            r = rate * (1 - step / (epochs * len(docs)))
            step += 1
            mean = [sum(n / total * table[b][k] for b, n in found.items()) for k in range(dim)]
            z = [sum(layer[c][k] * mean[k] for k in range(dim)) + bias[c] for c in range(2)]
            top = [math.exp(v - max(z)) for v in z]
            error = [v / sum(top) - (c == y) for c, v in enumerate(top)]
            back = [sum(error[c] * layer[c][k] for c in range(2)) for k in range(dim)]
            for c in range(2):
                bias[c] -= r * 0.0005 * error[c]
                for k in range(dim):
                    layer[c][k] -= r * 0.05 * error[c] * mean[k]
            for b, n in found.items():
                for k in range(dim):
                    table[b][k] -= r * n / total * back[k]

    def score(text):
        found = quality_features(text, bits)
        total = max(1, sum(found.values()))
        mean = [sum(n / total * table[b][k] for b, n in found.items()) for k in range(dim)]
        z = [sum(layer[c][k] * mean[k] for k in range(dim)) + bias[c] for c in range(2)]
        return logistic(z[1] - z[0])
    return score


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_equals_plain_sgd(seed):
    how = dict(bits=10, dim=4, epochs=3, rate=20.0, seed=seed)
    sample = corpus(seed)
    model, plain = quality.train(sample, **how), plain_sgd(sample, **how)
    texts = [t for t, _ in corpus(seed + 10)]
    expected = [plain(t) for t in texts]
    assert np.abs(scores(model, texts) - expected).max() < 1e-3
    assert max(expected) - min(expected) > 0.05  # something was learned


def test_quality_score_does_not_depend_on_the_place_in_a_chunk():
    sample = corpus(3)
    model = quality.train(sample, bits=10, dim=4, epochs=1, rate=20.0)
    texts = [t for t, _ in sample]
    alone = np.concatenate([scores(model, [t]) for t in texts])
    assert np.abs(alone - scores(model, texts)).max() < 1e-12
    assert np.abs(alone[::-1] - scores(model, texts[::-1])).max() < 1e-12


# --- op 8 --------------------------------------------------------------------------------------

def toxic_features(text, bits):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    hashes = [word_hash(w, tn.ALNUM, True)
              for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)]
    found = {h >> (64 - bits) for h in hashes}
    for gap in toxicity.SKIPS:
        for a, b in zip(hashes, hashes[gap:]):
            pair = int(tn.mix(np.array([(a * 0xC2B2AE3D27D4EB4F + b + gap) & M64], np.uint64))[0])
            found.add(pair >> (64 - bits))
    return found


def plain_ftrl(sample, bits, alpha, beta, l1, l2, epochs, seed):
    z, n = Counter(), Counter()

    def weight(i):
        cut = 0 if i == "bias" else l1
        if abs(z[i]) <= cut:
            return 0.0
        return -math.copysign(abs(z[i]) - cut, z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    docs = [(sorted(toxic_features(t, bits)) + ["bias"], y) for t, y in sample]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            found, y = docs[d]
            w = {i: weight(i) for i in found}
            g = logistic(sum(w.values())) - y
            for i in found:
                rate = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - rate * w[i]
                n[i] += g * g
    return {i: weight(i) for i in list(z) if weight(i)}


@pytest.mark.parametrize("seed", [1, 2])
def test_toxicity_equals_plain_ftrl(seed):
    how = dict(bits=14, alpha=1.0, beta=1.0, l1=1.0, l2=0.1, epochs=3, seed=seed)
    sample = corpus(seed)
    model, plain = toxicity.train(sample, **how), plain_ftrl(sample, **how)
    bias = plain.pop("bias", 0.0)
    assert dict(zip(model.index.tolist(), model.weight.tolist())) == pytest.approx(plain, abs=1e-5)
    assert model.bias == pytest.approx(bias, abs=1e-9) and plain
    texts = [t for t, _ in corpus(seed + 10)]
    expected = [logistic(bias + sum(plain.get(i, 0.0) for i in toxic_features(t, how["bits"]))) for t in texts]
    assert np.abs(scores(model, texts, model.dense()) - expected).max() < 1e-5
