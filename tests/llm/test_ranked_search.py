"""Op 13: ranks against the full sum over all documents; skipping; awkward rows."""

import math
import random
import re
from collections import Counter

import odd
import pytest

from histwright.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=20):
    """item_id -> [(rank, doc_id, score)] by the definition alone."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    n, total = sum(bool(t) for _, t in held), sum(t.total() for _, t in held)
    out = {}
    for item, text in items:
        asked = terms(text)
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in x for _, x in held) + 1))) for t in set(asked)}
        scored = []
        for d, x in held:
            m = 75 + 25 * x.total() * n // max(1, total)
            s = sum(weight[t] * (10 ** 9 * x[t] // (1000 * x[t] + 12 * m)) for t in asked if t in x)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort(key=lambda r: r[:3])
        out[item] = [(i, r[3], -r[0]) for i, r in enumerate(scored[:k], 1)]
    return {i: r for i, r in out.items() if r}


def found(df):
    out = {}
    for r in df.orderBy("item_id", "rank").collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return out


def corpus(rnd, n):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        size = rnd.choice([0, 1, 5, 30, 200])
        rows.append((i, " ".join(words[min(399, int(rnd.expovariate(0.02)))] for _ in range(size))))
    rows += [(n + i, rows[5][1] + " copy here") for i in range(60)]  # ties
    items = [(i, " ".join(words[min(399, int(rnd.expovariate(0.015)))] for _ in range(rnd.choice([1, 4, 12])))) for i in range(25)]
    items += [(30, "Copy, HERE!"), (31, "nowhere"), (32, ""), (33, None), (34, "w1 w1 w1 w2"), (35, rows[5][1])]
    return rows, items


@pytest.mark.parametrize("bounds", [{}, {"short": 0}, {"short": 10 ** 9}, {"short": 20, "segment_docs": 37},
                                    {"short": 40, "segment_entries": 500, "query_bytes": 100, "term_bytes": 10}])
def test_ranks_equal_full_sums(spark, bounds, monkeypatch):
    monkeypatch.setattr(ranked_search, "RANGE_DOCS", 64)
    rows, items = corpus(random.Random(3), 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked_search.rank(docs, queries, **bounds)) == plain(rows, items)


def test_awkward_tables(spark):
    items = [(1, "base1 base2"), (1, "base1 base2"), (2, "漢字 Ünï"), (None, "one"), (3, odd.LONG)]
    queries = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as query", "3 as score")
    rows = [(r[0], r[1]) for r in odd.rows()]
    got = found(ranked_search.rank(odd.table(spark), queries))
    assert got == plain(rows, [items[0], *items[2:]])
    assert [r[1] for r in got[None]] == [7, 8]
    assert ranked_search.rank(odd.none(spark), queries).count() == 0
    assert ranked_search.rank(odd.table(spark), queries.limit(0)).count() == 0


def test_long_lists_are_skipped():
    """With a few good documents found first, far fewer entries of the long lists are looked up than there are."""
    import numpy as np
    import pyarrow as pa
    rnd = random.Random(1)
    segment = ranked_search.Segment()
    texts = ["rare " * 30 + "the of"] * 25 + [" ".join(["the"] * rnd.randint(1, 2) + ["of"] + ["pad"] * 40) for _ in range(20_000)]
    raw = np.frombuffer("\n".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    offs[-1] -= 1
    number, doc, names = ranked_search.terms_of(raw, offs)
    segment.add(pa.array(range(len(texts))), np.bincount(doc, minlength=len(texts)), number, doc, names)
    lists = ranked_search.Lists(segment.batch().to_pylist()[0], len(texts), len(doc))
    best = ranked_search.Best(20)
    looked = lists.evaluate([("rare", 6000), ("the", 3), ("of", 2)], best, short=256)
    assert set(best.doc.tolist()) <= set(range(25)) and len(best.doc) == 20
    assert looked < 0.05 * 40_000


def test_terms_at_borders():
    import numpy as np
    raw = np.frombuffer("abC9 d-é e".encode() + b"xyz", np.uint8)
    offs = np.array([0, 0, 4, len(raw) - 3, len(raw), len(raw)])
    number, doc, names = ranked_search.terms_of(raw, offs)
    words = [names[i].as_py().decode() for i in number.tolist()]
    assert words == ["abc9", "d", "é e", "xyz"] and doc.tolist() == [1, 2, 2, 3]
