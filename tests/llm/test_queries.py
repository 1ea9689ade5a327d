"""The registered queries on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as E
from comptoir.llm.queries import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = sorted(d[0] for d in cur.description)
    names = [d[0] for d in cur.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == cols
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == sorted(
        tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall())


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline as P

    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, step) in enumerate(P.STAGES):
        out = P.stage(step(spark, docs, SF), "test-pipeline")
        if i < len(P.STAGES) - 1:
            assert out.columns == first.columns
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
        docs = out
    assert docs.count() > 0.6 * first.count()
