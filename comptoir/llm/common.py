"""Helpers shared by the operators: staged tables, text to words, word hashes.

A *staged* table is written as Parquet below ``spark.checkpoint.dir`` and read
back: it is computed once, keeps its rows when executors are lost, and cuts
the lineage. Operators identify a document by ``doc_id`` and, where rows may
repeat a ``doc_id`` with another text, by the text's 64-bit hash as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.session import scratch_path

#: Rows per Arrow batch: bounds what a Python worker holds when some texts are very long.
ROWS_PER_BATCH = 1000

#: The six ASCII white-space characters.
BLANKS = " \t\n\x0b\x0c\r"

# Every byte of a UTF-8 text to itself (A-Z lower-cased) if it belongs to a word, to a blank if not.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``ROWS_PER_BATCH`` rows at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_hash() -> Column:
    """Tells apart the texts of rows that repeat a ``doc_id``."""
    return F.xxhash64("text")


def carried(df: DataFrame, outputs: list[str]) -> list[Column]:
    """The columns of ``df`` that none of ``outputs`` replaces (names compared as Spark does, without case)."""
    taken = {c.lower() for c in outputs}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]


def alnum_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return [] if text is None else text.encode().translate(_WORD_BYTES).split()


def blank_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text, unchanged, as UTF-8."""
    return [] if text is None else text.encode().split()


class WordHashes(dict):
    """64-bit hash by word. Remembers at most ``most`` words, so that a task's memory stays bounded."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < self.most:
            self[word] = h
        return h


def batch_of(columns: dict[str, tuple[list | pa.Array, pa.DataType | None]]) -> pa.RecordBatch:
    """A record batch from lists with their Arrow types (None: the column is an Arrow array already)."""
    arrays = [v if kind is None else pa.array(v, kind) for v, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def extended(df: DataFrame, inputs: list[Column], outputs: str, work) -> DataFrame:
    """``df`` with further columns made in Python workers; columns named as one of ``outputs`` (a schema) give way.

    ``work`` turns an iterator over the batches of ``inputs`` (lists of Arrow arrays) into one over (places, arrays): the
    arrays of the outputs and the rows of the batch they belong to (None: all). The other columns
    travel under numbers, so their names, dots and double underscores included, clash with nothing.
    """
    made = T.StructType.fromDDL(outputs)
    taken = {f.name.lower() for f in made}
    kept = [(f, df[f"`{f.name}`"]) for f in df.schema if f.name.lower() not in taken]
    sent = df.select(*(c.alias(f"k{i}") for i, (_, c) in enumerate(kept)), *(c.alias(f"x{i}") for i, c in enumerate(inputs)))
    n = len(kept)
    schema = T.StructType([*(T.StructField(f"k{i}", f.dataType) for i, (f, _) in enumerate(kept)),
                           *(T.StructField(f"o{i}", f.dataType) for i, f in enumerate(made))])
    names = schema.fieldNames()

    def run(batches):
        held = []

        def arrays():
            for b in batches:
                held.append(b.columns[:n])
                yield b.columns[n:]

        for places, made in work(arrays()):
            columns = held.pop()
            if places is not None:
                columns = [c.take(places) for c in columns]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=names)

    return sent.mapInArrow(run, schema).toDF(*(f.name for f, _ in kept), *made.names)


def task_ids() -> Iterator[int]:
    """Numbers that no two rows of a job share: the task's partition in the high bits. Stage the rows that carry them."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    n = (ctx.partitionId() if ctx else 0) << 40
    while True:
        yield n
        n += 1
