"""The pipeline's near-dedup keeps exactly one row of each group, with null and repeated ids too."""

import pytest
from llm_rows import text

import corpus_pipeline

T, U, V, W = (text(s, 40) for s in (60, 61, 62, 63))
NEAR = [(None, T), (1, T)]  # a null id near an id


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    out = corpus_pipeline.near_dedup_stage(spark, df.repartition(3), "")
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


@pytest.mark.parametrize("rows, exp", [
    ([*NEAR, (None, U), (None, V)], [(1, T), (None, U), (None, V)]),  # null ids with texts of their own stay
    ([(3, T), (5, T), (5, U)], [(3, T), (5, U)]),  # a repeated id loses only the row that repeats a text
    ([(3, T), (5, T), (5, U), (9, U)], [(3, T), (5, U)]),  # the group of U doesn't vanish with its representative
    ([(3, T), (3, T), (4, T)], [(3, T)]),  # rows that repeat the smallest id
    ([(None, T), (None, T), (None, U)], [(None, T), (None, U)]),  # a group of null ids alone
    ([(1, ""), (2, None), (7, W)], [(1, ""), (7, W)]),
    ([], []),
])
def test_one_row_of_each_group_stays(spark, rows, exp):
    assert kept(spark, rows) == sorted(exp, key=str)
