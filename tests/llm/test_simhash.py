"""Op 4 against a plain computation with the same term hash, search against all pairs, awkward rows."""

import collections
import functools
import hashlib
import random
import re
import struct

import odd
import pytest
import xxhash
from pyspark.sql import functions as F

from histwright.llm import queries, simhash


def h64(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(struct.pack("<i", v) if isinstance(v, int) else v.encode(), seed=seed).intdigest()
    return seed


@functools.cache
def brute(text):
    votes = [[0] * 64, [0] * 64]
    for term, n in collections.Counter(re.split(r"\s+", text or "")).items():
        w = min(len(term.encode()), simhash.MAX_WEIGHT) * n
        for i in range(2):
            h = h64(i, term)
            for k in range(64):
                votes[i][k] += w if h >> k & 1 else -w
    return "".join(f"{sum(1 << k for k in range(64) if v[k] > 0):016x}" for v in votes)


def test_fingerprints_equal_plain_votes(spark, monkeypatch):
    docs = odd.table(spark)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = queries.op4_simhash(spark, "").collect()
    assert len(got) == len(odd.rows())
    texts = {}
    for doc_id, text, *_ in odd.rows():
        texts[doc_id] = text or ""
    ids = sorted((i for i in texts if i is not None), reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    for r in got:
        if r.doc_id is None:
            continue
        text = texts[r.doc_id]
        k = len(text) // 3
        edited = text[:len(text) - k] + texts[after[r.doc_id]][:k]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), r.doc_id
        assert r.fingerprint == brute(text), r.doc_id
        assert r.edited_fingerprint == brute(edited), r.doc_id
        bits = bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1")
        assert abs(r.near_edited - (1 - bits / 128)) < 1e-12
        bits = bin(int(r.fingerprint, 16) ^ int(brute(texts[after[r.doc_id]]), 16)).count("1")
        assert abs(r.near_next - (1 - bits / 128)) < 1e-12


def test_search_finds_every_pair_in_the_radius(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(128) for _ in range(30)]
    prints = []
    for x in base:
        prints.append(x)
        for flips in (1, 2, 3, 4, 5, 6, 9, 10, 11, 12, 13):
            y = x
            for b in rnd.sample(range(128), flips):
                y ^= 1 << b
            prints += [y] * (flips % 2 + 1)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    df = spark.createDataFrame(rows, "f0 long, f1 long")
    for radius, blocks, flips in ((3, 4, 0), (2, 4, 0), (5, 8, 0), (7, 4, 1), (11, 4, 2)):
        got = {(r.f0, r.f1): r.n_within for r in simhash.near_counts(df, df, radius, blocks, flips).collect()}
        for p, row in zip(prints, rows):
            assert got[row] == sum(bin(p ^ q).count("1") <= radius for q in prints)
    for wrong in ((4, 4, 0), (12, 4, 2), (5, 8, 1), (5, 6, 0)):
        with pytest.raises(ValueError):
            simhash.near_counts(df, df, *wrong)


def shingles(words):
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_search_finds_edited_copies(spark):
    """Words replaced, dropped or put in: of the copies that keep a similarity of 0.75, over 0.9 are found."""
    rnd = random.Random(4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").toArrow().to_pylist()
    texts = [r["text"].split() for r in sorted(docs, key=lambda r: r["doc_id"]) if 250 <= len(r["text"] or "") <= 8000]
    vocabulary = sorted({w for words in texts for w in words})
    rows, alike = [], 0
    for words in texts[:200]:
        for changes in (1, 2, 4, 7):
            new = list(words)
            for i in rnd.sample(range(len(new)), min(changes, len(new))):
                word = rnd.choice(vocabulary)
                new[i] = rnd.choice([word, "", f"{new[i]} {word}"])
            a, b = shingles(words), shingles(" ".join(new).split())
            if len(a & b) >= 0.75 * len(a | b):
                rows += [(alike, "a", " ".join(words)), (alike, "b", " ".join(" ".join(new).split()))]
                alike += 1
    df = spark.createDataFrame(rows, "pair long, side string, text string")
    prints = simhash.fingerprints(df, ["pair", "side"])
    both = (prints.where("side = 'a'").select("pair", F.col("f0").alias("a0"), F.col("f1").alias("a1"))
            .join(prints.where("side = 'b'"), "pair"))
    bits = simhash.hamming([F.col("a0"), F.col("a1")], [F.col("f0"), F.col("f1")])
    within = both.where(bits <= simhash.RADIUS).count()
    assert alike > 400 and within > 0.9 * alike, (within, alike)
    # The search itself misses none of them: each copy asked alone finds at least itself and its source.
    asked = both.where(bits <= simhash.RADIUS).select("f0", "f1").distinct()
    sources = both.select(F.col("a0").alias("f0"), F.col("a1").alias("f1")).distinct()
    assert simhash.near_counts(asked, sources).count() == asked.count()


def test_plan_is_native(spark):
    df = spark.createDataFrame(odd.rows(), odd.SCHEMA)
    plan = simhash.fingerprints(df.withColumn("id", F.monotonically_increasing_id()), ["id"]) \
        ._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_neighbours_over_gaps_and_empty(spark):
    ids = [-5, 3, 4, 1000, 10**15]
    df = spark.createDataFrame([(i,) for i in [*ids, 3, None]], "doc_id long").repartition(4)
    got = {r.doc_id: r.next_id for r in simhash.next_ids(df).collect()}
    assert got == dict(zip(ids, [ids[-1], *ids[:-1]]))
    assert simhash.next_ids(df.limit(0)).count() == 0
    assert simhash.edited_prints(odd.none(spark)).count() == 0
