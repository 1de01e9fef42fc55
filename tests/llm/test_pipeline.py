from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline as pipeline
import pytest

from newsloom.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert [name for name, _ in pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "source_mix", "best_fit_packing"]


def test_stages_hand_on_documents(spark):
    docs, sizes = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.spool(stage(spark, docs, FOLDER), name)
        assert docs.columns == COLUMNS
        sizes.append((docs.count(), docs.select("doc_id").distinct().count()))
    assert sizes[0][0] >= sizes[1][0] == sizes[2][0] == sizes[2][1]
    packed = pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == sizes[3][1]
    assert packed.where("piece = 0").count() == sizes[3][0]


def test_run_is_the_stages(spark):
    rows = pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() == pipeline.run(spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_odd_rows_pass_each_stage(spark, docs, no_docs, name):
    stage = dict(pipeline.STAGES)[name]
    assert stage(spark, no_docs, FOLDER).count() == 0
    got = stage(spark, docs, FOLDER)
    assert got.count() > 0
    if name != "best_fit_packing":
        assert got.columns == docs.columns
