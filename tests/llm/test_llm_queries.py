"""Every registered corpus query on the smallest tables, the pipeline, and the reference SQL."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from chronolake.llm import oracles, queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.registered()) | {"pipeline"} <= names


@pytest.mark.parametrize("name", list(oracles.sql()))
def test_against_reference_sql(spark, name):
    assert compare(queries.registered()[name](spark, FOLDER), oracles.sql()[name], connect(FOLDER)) is None


def test_pipeline(spark, awkward):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.count() > 0
    assert {r.doc_id for r in found.select("doc_id").distinct().collect()} <= {r.doc_id for r in docs.collect()}
    rows = awkward.selectExpr("doc_id", "text", "lang", "source", "length(text) AS n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, FOLDER)
        assert after.columns == rows.columns, name
        assert stage(spark, rows.limit(0), FOLDER).count() == 0
        rows = after.checkpoint()
    assert corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).count() >= rows.count() > 0
