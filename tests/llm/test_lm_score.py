"""Op 10 against plain counts and probabilities, and awkward rows."""

import math
import re
from collections import Counter

import odd
import pytest
from pyspark.sql import functions as F

from histwright.llm import lm_score, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def plain(rows, vocabulary, bigrams):
    """rows: (doc_id, text, target). Scores by dictionaries."""
    uni = [Counter(), Counter()]
    for _, text, target in rows:
        for m in ([0, 1] if target else [1]):
            uni[m].update(words(text))
    total = [sum(c.values()) for c in uni]
    vocab = {w for w, n in uni[1].items() if n * vocabulary >= total[1]}
    fold = lambda w: w if w in vocab else None
    pair, single = [Counter(), Counter()], [Counter(), Counter()]
    for _, text, target in rows:
        w = [fold(x) for x in words(text)]
        for m in ([0, 1] if target else [1]):
            single[m].update(w)
            pair[m].update(zip(["<s>", *w[:-1]] if w else [], w))
    kept = {k for k, n in pair[1].items() if n * bigrams >= total[1]}
    ctx = []
    for m in range(2):
        c = Counter(single[m])
        c["<s>"] = sum(pair[m][k] for k in kept if k[0] == "<s>")
        ctx.append(c)

    def p(m, u, w):
        base = (single[m][w] + lm_score.SMOOTH) / (total[m] + lm_score.SMOOTH * (len(vocab) + 1))
        top = {k: lm_score.MIX * pair[m][k] / ctx[m][u] for k in kept if k[0] == u} if ctx[m][u] else {}
        return (1 - sum(top.values())) * base + top.get((u, w), 0)

    out = {}
    for doc, text, _ in rows:
        w = [fold(x) for x in words(text)]
        loss = [sum(-math.log(p(m, u, x)) for u, x in zip(["<s>", *w], w)) / max(1, len(w)) for m in range(2)]
        out[doc] = (len(w), *loss, loss[0] - loss[1])
    return out


@pytest.mark.parametrize("vocabulary,bigrams", [(100_000, 250_000), (20, 30)])
def test_equals_plain_counts(spark, vocabulary, bigrams):
    import random
    rnd = random.Random(6)
    rows = [(d, " ".join(rnd.choice("the of A b c dd ee ff gg hh".split()) for _ in range(rnd.randint(0, 25))),
             d % 3 == 0) for d in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(4)
    models = lm_score.fit(df, vocabulary, bigrams)
    got = {r.doc_id: (r.n_words, r.target_loss, r.background_loss, r.score) for r in lm_score.score(df, models).collect()}
    want = plain(rows, vocabulary, bigrams)
    for d in want:
        assert got[d] == pytest.approx(want[d], abs=1e-9), d


def test_awkward_rows(spark):
    docs = odd.table(spark)
    models = lm_score.fit(docs.withColumn("target", F.col("doc_id") < 3))
    got = lm_score.score(docs, models).collect()
    assert len(got) == len(odd.rows())
    assert all(r.score == 0 and r.n_words == 0 for r in got if r.doc_id in (4, 5, 6))
    assert all(math.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    # The target's own text is closer to the target.
    base, other = ([r.score for r in got if r.doc_id == d][0] for d in (2, 12))
    assert base < other
    alone = lm_score.fit(docs.withColumn("target", F.lit(False)))
    assert all(math.isfinite(r.score) for r in lm_score.score(docs, alone).collect())
    empty = lm_score.fit(odd.none(spark).withColumn("target", F.lit(True)))
    assert lm_score.score(odd.none(spark), empty).count() == 0
    assert all(math.isfinite(r.score) for r in lm_score.score(docs, empty).collect())


@pytest.mark.parametrize("part", [lm_score.PART, 300])
def test_whole_models_equal_plain_counts(spark, part):
    import random
    rnd = random.Random(8)
    # One word and one bigram in all documents, and rare words that a share of 1/250,000 would keep only here.
    rows = [(d, "the hot " + " ".join(rnd.choice(["a", "B", "cc", f"rare{d}", f"twice{d // 2}"])
                                      for _ in range(rnd.randint(0, 25))), d % 3 == 0) for d in range(60)]
    rows += [(70, None, True), (71, " \n", False), (72, "alone", True)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    ids = spark.createDataFrame([(r[0],) for r in rows if r[2]] + [(None,), (999,), (0,)], "doc_id long")
    got = {r.doc_id: tuple(r)[1:] for r in lm_score.score_all(df, ids, part).collect()}
    want = plain(rows, 10**9, 10**9)
    assert len(got) == len(rows)
    for d in want:
        assert got[d] == pytest.approx(want[d], abs=1e-9), d


def test_query_keeps_rare_words_in_a_large_corpus(spark, tmp_path):
    # 120,000 words, so one occurrence of a word is below the former share of 1/100,000.
    rows = [(d, "the of and to in " * 400, False) for d in range(60)]
    rows += [(100, "the zebra", True), (101, "the zebra", False), (102, "the gnu", False)]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100, 1), (0, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_cross_entropy_difference(spark, str(tmp_path)).collect()}
    want = plain(rows, 10**9, 10**9)
    for d in want:
        assert got[d] == pytest.approx(want[d], abs=1e-9), d
    assert got[101][3] < got[102][3]


def test_whole_models_on_awkward_rows(spark):
    docs = odd.table(spark)
    got = lm_score.score_all(docs, docs.where("doc_id < 3").select("doc_id")).collect()
    assert len(got) == len(odd.rows())
    assert all(r.score == 0 and r.n_words == 0 for r in got if r.doc_id in (4, 5, 6))
    assert all(math.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert lm_score.score_all(odd.none(spark), docs.select("doc_id")).count() == 0
    assert all(math.isfinite(r.score) for r in lm_score.score_all(docs, docs.select("doc_id").limit(0)).collect())
