"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

1. quality classifier: documents whose probability of the clean grade is under a half go
2. line dedup: lines repeated in at least three documents stay in one of them
3. SimHash near-dedup: of each group one row stays, the smallest by (id, nulls last; hash of the text; place)
4. benchmark decontamination: the words of benchmark passages are cut out
5. byte-level BPE: documents as token ids, with counts and digests

The first four return the columns of ``documents``; ``n_chars`` follows the text. Columns may have any names but
``doc_id`` and ``text``: an operator sees only numbers for them.
Empty tables give empty results; nulls are handled as each operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import bpe, decontam, line_dedup, quality, simhash
from comptoir.llm.common import stage, table
from comptoir.llm.queries import tokenizer


KEY = ("doc_id", "text")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns beside id and text under numbers, so that no operator's output takes the place of one."""
    return docs.toDF(*(c if c in KEY else f"c{i}" for i, c in enumerate(docs.columns)))


def _named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, by their names, from what an operator made of ``_numbered(docs)``."""
    return rows.select(*_numbered(docs).columns).toDF(*docs.columns)


def _edited(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """As ``_named``, with ``n_chars`` of the text as it is now (null text: as it was)."""
    if "n_chars" in docs.columns:
        c = _numbered(docs).columns[docs.columns.index("n_chars")]
        n = F.coalesce(F.char_length("text").cast("long"), F.col(c)).cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn(c, n)
    return _named(rows, docs)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The ratings are of the documents as they come in, so the model is trained on them.
    model = quality.train(docs.select(*KEY), quality.grades(table(spark, sf_dir, "labels")))
    return _named(quality.score(_numbered(docs), model).where("keep"), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_numbered(docs), min_chars=20, min_docs=3)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("kept_text"))
    return _edited(kept.withColumn("text", text), docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _named(simhash.one_per_component(_numbered(docs), shingle_words=3, max_bits=3), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _edited(decontam.decontaminate(_numbered(docs), table(spark, sf_dir, "benchmark")), docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs.select(*KEY), *tokenizer(), with_ids=True).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE encoding and decoding", tokens_stage),
]

#: A trained classifier and a tokenizer are not SQL. tests/llm compares the stages after the classifier, one after the other,
#: with a plain Python version, the classifier's decisions with the formula given the trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; each result is staged and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{i + 1}")
    return docs
