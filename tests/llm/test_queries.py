"""Registered queries on the driver's smallest tables: SQL, contracts and accuracy on held-out rows."""

import glob
import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from waybill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_languages_and_toxicity_on_held_out_rows(spark, duck):
    lang = dict(duck.execute("select doc_id, lang from documents").fetchall())
    rows = QUERIES["op8_language_id"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    toxic = dict(duck.execute("select doc_id, toxic from labels").fetchall())
    rows = [r for r in QUERIES["op1_toxicity"](spark, SF).collect() if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) >= 0.9 * len(rows)


def test_pipeline_stage_by_stage(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), before.schema)
        kept.append([r.doc_id for r in docs.collect()])
        assert docs.columns == before.columns
    good = {r.doc_id for r in QUERIES["op2_quality_rules"](spark, SF).where("kept").collect()}
    assert set(kept[0]) == good and set(kept[1]) <= good and len(set(kept[1])) == len(kept[1])
    assert set(kept[2]) < set(kept[1]) and set(kept[3]) <= set(kept[2]) and max(map(kept[3].count, set(kept[3]))) <= 2
    leaks = {r.doc_id for r in QUERIES["op10_benchmark_decontamination"](spark, SF).collect()}
    assert set(kept[2]) == set(kept[1]) - leaks
    last = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(kept[3])
