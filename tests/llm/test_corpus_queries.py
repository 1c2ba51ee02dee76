"""Every registered corpus query against its SQL, and the pipeline against its stages' rules."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from emberlog.llm import queries, shingle_join, toxicity  # noqa: E402
from tools.check_queries import TABLES, rows_of  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, small, name):
    database = duckdb.connect(config={"memory_limit": "4GB"})
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, small)
    result = database.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("number", range(1, 14))
def test_every_operator_has_a_query(spark, small, number):
    name = next(q for q in queries.QUERIES if q.startswith(f"op{number}_"))
    assert queries.QUERIES[name](spark, small).count() > 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = corpus_pipeline.table(stage(spark, docs, folder), name)
        assert result.columns == columns
        after = {r.doc_id: r.text for r in result.collect()}
        assert set(after) <= set(before)
        if name == "toxicity":
            rejected = {r.doc_id for r in toxicity.score_documents(docs, labels).where("predicted = 1").select("doc_id").collect()}
            assert set(before) - set(after) == rejected and rejected
        elif name == "near_duplicates":
            groups = {r.doc_id: r.component_id for r in shingle_join.similar_groups(docs, size=5, percent=80).collect()}
            assert set(after) == set(groups.values()) & set(before)
        elif name == "secrets":
            assert set(after) == set(before) and any(after[d] != before[d] for d in after)
        else:
            assert 0.75 * len(before) < len(after) <= len(before)
        docs, before = result, after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == set(before)


def test_pipeline_runs_whole(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.count() > 0 and "sequence_id" in out.columns
