"""The pipeline's stages one by one, its queries' registration, and awkward rows."""

import odd
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from histwright.llm import queries, superminhash, winnowing
from histwright.llm.common import materialize

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_registered():
    names = set(entry.queries())
    assert {x.split("_")[0] for x in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= names
    assert [name for name, _ in pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination",
                                                    "packing"]


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "test")
        assert docs.columns == COLUMNS
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert kept["quality"] == kept["line_dedup"] > kept["near_duplicates"] >= kept["decontamination"]
    # What is left has neither near-duplicates nor benchmark spans.
    assert superminhash.near_duplicates(docs).where("not kept").count() == 0
    found = winnowing.decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert found.where("contaminated").count() == 0
    pieces = pipeline.packing_stage(spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == kept["decontamination"]
    # run() is these stages in a row.
    whole = pipeline.run(spark, SF)
    assert {r.doc_id for r in whole.select("doc_id").collect()} == kept["decontamination"]


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_on_awkward_rows(spark, name, stage):
    df = odd.table(spark)
    out = stage(spark, df, SF)
    if name == "packing":
        assert out.where("start = 0").count() == len(odd.rows())
    else:
        assert out.columns == df.columns
        ids = sorted(str(r.doc_id) for r in out.select("doc_id").collect())
        if name == "near_duplicates":
            assert ids == sorted(str(x) for x in (1, 4, 5, 6, 7, 9, None, None, 12))
        elif name != "quality":
            assert ids == sorted(str(r[0]) for r in odd.rows())
    empty = stage(spark, odd.none(spark), SF)
    assert empty.count() == 0 and (name == "packing" or empty.columns == COLUMNS)
