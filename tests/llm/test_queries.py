"""The registered queries on the smallest tables, and those with SQL against DuckDB."""

import glob

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from vidmart.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not glob.glob(f"{FOLDER}/documents.parquet"), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(queries.sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {path.split('/')[-1][:-8]} as select * from '{path}'")
    got = queries.registered()[name](spark, FOLDER)
    columns = ", ".join(sorted(got.columns))
    want = con.execute(f"select {columns} from ({queries.sql()[name]})").fetchall()
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect())) == sorted(want)


def test_all_are_registered():
    names = __spark_entry__.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not glob.glob(f"{FOLDER}/documents.parquet"), reason="needs the given tables")
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert 0 < docs.count() <= before
        if k < 4:
            assert docs.columns == columns
        before = docs.count()
    assert docs.where("n_tokens <> size(ids)").count() == 0


@pytest.mark.skipif(not glob.glob(f"{FOLDER}/documents.parquet"), reason="needs the given tables")
@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, none, stage):
    """Each stage takes nulls, blank and very long texts, repeated rows and ids, clashing columns, and no rows."""
    work = dict(corpus_pipeline.STAGES)[stage]
    out = work(spark, odd, FOLDER)
    got = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert set(got) <= {r["doc_id"] for r in odd.collect()} and len(got) <= odd.count()
    if stage == "byte-level BPE":
        assert len(got) == odd.count() and out.where("n_tokens = size(ids)").count() == len(got)
    else:
        assert out.columns == odd.columns
    if stage == "benchmark decontamination":
        assert len(got) == odd.count()
    assert work(spark, none, FOLDER).count() == 0
