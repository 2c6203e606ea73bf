"""Quality (op 1) and toxicity (op 8): held-out accuracy, equal texts, awkward rows."""

import zlib

import numpy as np
import odd
import pyarrow as pa
import pytest

from histwright.llm import quality, textnum as tn, toxicity
from histwright.llm.common import table, training_sample

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark):
    got = table(spark, SF, "documents").select("doc_id", "text").join(
        table(spark, SF, "labels"), "doc_id").toArrow().to_pylist()
    return sorted(got, key=lambda r: r["doc_id"])


def accuracy(labelled, label, model, cut):
    test = [r for r in labelled if held(r["doc_id"])]
    raw, offs = tn.utf8(pa.array([r["text"] for r in test]))
    extra = () if label == "quality" else (model.dense(),)
    score = np.concatenate([model.scores(r, o, *extra) for _, _, r, o in tn.chunks(raw, offs)])
    truth = np.array([r[label] for r in test])
    assert ((score >= 0) & (score <= 1)).all()
    order = score[truth == 1][:, None] - score[truth == 0][None, :]
    return ((score >= cut) == truth).mean(), (order > 0).mean() + (order == 0).mean() / 2


def test_quality_held_out(labelled):
    sample = [(r["text"], r["quality"]) for r in labelled if not held(r["doc_id"])]
    acc, auc = accuracy(labelled, "quality", quality.train(sample), 0.3)
    assert acc > 0.9 and auc > 0.95, (acc, auc)


def test_toxicity_held_out(labelled):
    sample = [(r["text"], r["toxic"]) for r in labelled if not held(r["doc_id"])]
    model = toxicity.train(sample)
    acc, auc = accuracy(labelled, "toxic", model, 0.5)
    assert acc > 0.88 and auc > 0.8, (acc, auc)
    assert len(model.index) < 2000  # L1 leaves few coordinates


def test_sample_is_bounded_and_never_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    a = training_sample(docs, labels, "quality", 50, 20_000)
    assert 0 < len(a) <= 50 and a == training_sample(docs.repartition(5), labels, "quality", 50, 20_000)
    assert all(len(t) <= 20_000 for t, _ in a)
    full = training_sample(docs, labels, "quality", 10**6, 10**9)
    n = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").join(docs, "doc_id").count()
    assert len(full) == n


@pytest.mark.parametrize("op", [quality, toxicity])
def test_awkward_rows(spark, op):
    few = odd.labels(spark, [(1, 1, 0), (2, 1, 0), (7, 0, 1), (8, 0, 1), (None, 1, 1), (9, None, None), (3, 7, 7)])
    model = op.fit(odd.table(spark), few)
    got = op.score(odd.table(spark), model).collect()
    assert len(got) == len(odd.rows())
    by_text = {}
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and held(r.doc_id))
    for r in got:
        if r.doc_id in (1, 2):
            by_text.setdefault("base", set()).add(r.score)
        if r.doc_id in (4, 5, 6):
            by_text.setdefault("empty", set()).add(r.score)
    assert all(len(v) == 1 for v in by_text.values())
    # No usable label: every document scores one half; an empty table gives no rows.
    nothing = op.fit(odd.table(spark), odd.labels(spark))
    assert {r.score for r in op.score(odd.table(spark), nothing).collect()} == {0.5}
    assert op.score(odd.none(spark), model).count() == 0


def test_keep_returns_all_columns(spark):
    model = quality.train([(odd.BASE, 1), ("!!", 0)])
    df = odd.table(spark)
    assert quality.keep(df, model, 0.0).columns == df.columns
    assert quality.keep(df, model, 0.0).count() == len(odd.rows())
    assert quality.keep(df, model, 1.1).count() == 0


def test_word_hash_and_ngrams_stay_inside_documents():
    raw, offs = tn.utf8(pa.array(["ab cd", "ab", None, "cdab"]))
    w = tn.Words(raw, offs, tn.NOT_SPACE)
    assert w.counts().tolist() == [2, 1, 0, 1]
    assert w.hash[0] == w.hash[2] and len(set(w.hash.tolist())) == 3
    for doc, bucket in quality.features(raw, offs):
        assert len(doc) == len(bucket) and (np.diff(doc) >= 0).all() and 2 not in doc
