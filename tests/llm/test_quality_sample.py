"""The bounded sample of rated documents: foreign ratings, one id rated very often, toxic ratings without quality."""

import pytest

from comptoir.llm import quality

MOST = 40


@pytest.fixture(scope="module")
def rows(spark):
    """Odd ids are bad."""
    texts = [(i, " ".join(f"{'bad' if i % 2 else 'good'}{(i + k) % 7} word{k}" for k in range(8))) for i in range(200)]
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3).localCheckpoint()


def right(spark, docs, extra):
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(200)] + extra, "doc_id long, quality int, toxic int")
    model = quality.train(docs, quality.grades(labels), most_rated=MOST, steps=6, ridge=0.1, tasks=2)
    out = quality.score(docs, model).select("doc_id", "keep").collect()
    return sum(r["keep"] == (r["doc_id"] % 2 == 0) for r in out) / len(out)


def test_ratings_of_other_texts_do_not_take_the_sample(spark, rows):
    assert right(spark, rows, [(1000 + i, 1, 0) for i in range(20_000)]) > 0.9


def test_an_id_rated_very_often_does_not_fill_the_sample(spark, rows):
    first = rows.orderBy(quality.F.xxhash64("doc_id")).first()["doc_id"]
    assert right(spark, rows, [(first, 1 - first % 2, 0)] * 2000) > 0.9


def test_toxic_needs_no_quality(spark):
    labels = spark.createDataFrame([(1, None, 1), (2, None, 0), (3, 1, None), (4, 1, 0), (5, 0, 0), (None, None, 1)],
                                   "doc_id long, quality int, toxic int")
    assert {(r[0], r[1]) for r in quality.grades(labels).collect()} == {(1, 0), (4, 2), (5, 1)}


def test_repeats_are_one_sample(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "doc_id long, text string")
    rated = spark.createDataFrame([(1, 2), (1, 2), (1, 0), (2, 1), (9, 1)], "doc_id long, grade int")
    rows = quality.sampled(docs, rated, 100).collect()
    assert sorted((r[0] or "", r[1]) for r in rows) == [("", 1), ("a", 0), ("a", 2), ("b", 0), ("b", 2)]
    assert quality.sampled(docs, rated, 3).count() == 3
