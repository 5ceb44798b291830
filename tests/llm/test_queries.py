"""Registered corpus queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
import oracle
from skygauge.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_statement(spark, name):
    con = oracle.connect(FOLDER)
    df = queries.QUERIES[name](spark, FOLDER)
    result = con.execute(queries.ORACLES[name])
    want = oracle._rows([d[0] for d in result.description], result.fetchall())
    assert oracle._rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        left = {r.doc_id for r in docs.collect()}
        assert left <= ids and docs.count() == len(left)
        if name == "quality":  # clean documents stay, bad ones go
            assert sum(labels.get(i) == 1 for i in ids - left) <= 0.05 * len(ids)
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == ids
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in again.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)
