import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import differences
from ledgerlens.llm.queries import QUERIES, SQL
from ledgerlens.llm.contamination import contamination
from ledgerlens.llm.mixing import mixed
from ledgerlens.llm.near_duplicates import near_duplicates

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, "/root/testdata/sf0.01", QUERIES[name], SQL[name]) is None


def test_registered_names():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != "source_mixing":
            assert docs.columns == columns
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0]
    # Each stage's result agrees with its operator on the stage's own input.
    near = near_duplicates(inputs["near_dedup"])
    kept = {r["doc_id"] for r in near.filter("kept").collect()}
    assert kept == {r["doc_id"] for r in inputs["decontamination"].collect()}
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    clean = {r["doc_id"] for r in contamination(inputs["decontamination"], benchmark).filter("NOT contaminated").collect()}
    assert clean == {r["doc_id"] for r in inputs["source_mixing"].collect()}
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, mixed(inputs["source_mixing"]).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, docs.collect()))
