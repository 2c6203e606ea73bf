"""Op 6 against a plain window search, on texts made to collide, and awkward rows."""

import random
import re

import odd
import pytest

from histwright.llm import winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.decontaminate(d, b, **how).drop("row_key").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_equals_window_search(spark, broadcast_rows):
    rnd = random.Random(broadcast_rows + 1)
    text = lambda n, k: rnd.choice([" ", ", ", "\n"]).join(
        rnd.choice(["Ab", "b1", "ça", "D", "e漢"][:k]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 6, 9, 10, 11, 25]), 5)) for i in range(30)] + [(3, "other b1 text"), (None, text(12, 5))]
    docs = []
    for d in range(60):
        t = text(rnd.choice([0, 5, 9, 10, 40, 200]), rnd.choice([2, 5]))
        if d % 2:
            src = words(rnd.choice(items)[1])
            cut = src[rnd.randint(0, 3):]
            t += " x " + " ".join(cut).upper() + " y"
        docs.append((d, t))
    assert run(spark, docs, items, broadcast_rows=broadcast_rows) == brute(docs, items)


def test_every_long_shared_span_is_found(spark):
    rnd = random.Random(9)
    item = [f"q{i}" for i in range(80)]
    docs = []
    for d in range(80):
        i = rnd.randint(0, 70)
        n = rnd.choice([9, 10, 11, 30])
        docs.append((d, " ".join([f"z{d}a{k}" for k in range(d)] + item[i:i + n] + [f"z{d}b{k}" for k in range(9)])))
    items = [(1, " ".join(item))]
    assert run(spark, docs, items) == brute(docs, items)


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, odd.BASE, 1), (1, odd.BASE, 2), (2, None, 3), (3, "", 4), (4, "one", 5)],
                                  "item_id long, text string, hits int")
    got = winnowing.decontaminate(odd.table(spark), items).drop("row_key").collect()
    want = brute([r[:2] for r in odd.rows()], [(1, odd.BASE), (2, None), (3, ""), (4, "one")])
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert winnowing.decontaminate(odd.none(spark), items).count() == 0
    clean = winnowing.decontaminate(odd.table(spark), items.limit(0)).collect()
    assert len(clean) == len(odd.rows()) and not any(r.contaminated for r in clean)
