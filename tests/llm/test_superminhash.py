"""Op 7: signatures against the plain walk, groups against all pairs, awkward rows; components."""

import random
import re

import numpy as np
import odd
import pytest

from pyspark.sql import functions as F

from histwright.llm import components as cc
from histwright.llm import superminhash as smh, textnum as tn


def plain_signature(elements, places):
    out = [None] * places
    for x in elements:
        p = list(range(places))
        for j in range(places):
            step = np.uint64((j + 1) * int(smh._G) & (2**64 - 1))
            y = int(tn.mix(np.array([x]) + step)[0])
            k = j + ((y >> 32) * (places - j) >> 32)
            p[j], p[k] = p[k], p[j]
            v = j << 32 | y & 0xFFFFFFFF
            if out[p[j]] is None or v < out[p[j]]:
                out[p[j]] = v
    return out


def test_signatures_equal_the_plain_walk():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 30, 0, 7)]
    got = smh.signatures(sets, 24)
    for s, row in zip(sets, got):
        if len(s):
            assert row.tolist() == plain_signature(s, 24)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    share = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 500, dtype=np.uint64)
        a, b = smh.signatures([np.sort(x[:400]), np.sort(x[100:])], 240)
        share.append((a == b).mean())
    assert abs(np.mean(share) - 300 / 500) < 0.02


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, set()).add(frozenset(shingles(text)))
    top = {d: d for d in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(x for x in sets if x is not None)
    for i, u in enumerate(ids):
        for v in ids[:i]:
            if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[u] for b in sets[v]):
                a, b = root(u), root(v)
                top[max(a, b)] = min(a, b)
    out = []
    for doc, text in rows:
        c = root(doc) if doc is not None else None
        out.append((doc, len(shingles(text)), c, c == doc))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in smh.near_duplicates(df).collect()), key=repr)


def test_groups_equal_all_pairs(spark):
    rnd = random.Random(4)
    rows, base = [], [[f"b{g}w{i}" for i in range(rnd.randint(3, 90))] for g in range(25)]
    passage = [f"p{i}" for i in range(60)]
    for d in range(260):
        if d % 4 == 0:  # own text around a passage that many share
            t = [f"d{d}w{i}" for i in range(rnd.randint(5, 60))] + passage
        else:  # copies of a base with several edits, near and far
            t = list(base[0] if d % 4 == 1 else rnd.choice(base))
            for _ in range(rnd.randint(0, 5)):
                t[rnd.randrange(len(t))] = f"e{d}x{rnd.randint(0, 3)}"
        rows.append((d * 7 + 3, rnd.choice([" ", "\n"]).join(t).title() if d % 5 == 0 else " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == brute(rows)


def test_awkward_rows(spark):
    rows = [r[:2] for r in odd.rows()] + [(20, odd.BASE), (20, "another text under the same id, far from the base text"),
                                          (21, "another text under the same id, far from the base text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(d, n, c, True if d is None else k) for d, n, c, k in brute(rows)]
    assert got(df.selectExpr("*", "1 as rep", "2 as keys", "3 as digest", "4 as u")) == sorted(want, key=repr)
    assert smh.near_duplicates(odd.none(spark)).count() == 0


@pytest.mark.parametrize("links_per_task", [200_000, 7])
def test_components(spark, monkeypatch, links_per_task):
    monkeypatch.setattr(cc, "LINKS_PER_TASK", links_per_task)
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(rnd.randint(100, 140), rnd.randint(100, 140)) for _ in range(30)]
    links += [(200, x) for x in range(201, 230)] + [(5, 5)]
    rnd.shuffle(links)
    found = {r.node: r.root for r in cc.components(spark.createDataFrame(links, "u long, v long")).collect()}
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for u, v in links:
        a, b = root(u), root(v)
        top[max(a, b)] = min(a, b)
    assert found == {x: root(x) for x in top if root(x) != x}
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_star_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(cc, "LINKS_PER_TASK", 200)
    most, plain = [], cc.local_forest

    def spy(links):
        most.append(max(r["count"] for r in links.groupBy(F.spark_partition_id()).count().collect()))
        return plain(links)

    monkeypatch.setattr(cc, "local_forest", spy)
    links = spark.createDataFrame([(i, 0) for i in range(1, 2001)], "u long, v long")
    assert {tuple(r) for r in cc.components(links).collect()} == {(i, 0) for i in range(1, 2001)}
    assert len(most) > 1 and max(most) <= 2 * 200


def _hot_group(spark, n):
    """One group of near copies (chained to one component) with outsiders of other groups that share its buckets."""
    base = [f"base{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = list(base)
        words[5 + i % 50] = f"own{i}"  # one word of its own: similar to the rest of the group
        rows.append((i, " ".join(words)))
    for i in range(n // 20):  # half of the words are the group's
        rows.append((n + i, " ".join(base[:35] + [f"out{i}w{k}" for k in range(25)])))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(8)


def test_pairs_of_a_hot_group_grow_with_its_size(spark, monkeypatch):
    """What is compared grows in proportion to the group, not with its square."""
    from histwright.llm import superminhash

    compared = []
    plain = superminhash.overlaps

    def counted(pairs, sets):
        compared[-1] += pairs.count()
        return plain(pairs, sets)

    monkeypatch.setattr(superminhash, "overlaps", counted)
    for n in (500, 2000):
        compared.append(0)
        got = superminhash.near_duplicates(_hot_group(spark, n), bands=60, rows=2)
        assert got.where(f"doc_id < {n}").select("component_id").distinct().count() == 1
        assert got.where(f"doc_id >= {n} and not kept").count() == 0
    assert compared[1] < 6 * compared[0], compared
