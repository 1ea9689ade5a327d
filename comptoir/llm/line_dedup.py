"""Line dedup with two Bloom filters (operator 2).

A line's key is the line without blanks at both ends, A-Z lower-cased. A key of
at least ``min_chars`` code points that stands in at least ``min_docs``
documents is a repeat: all its lines go, except in the document with the
largest ``doc_id`` that has it.

1. All tasks add the key hashes of their documents to two Bloom filters
   (:mod:`~comptoir.llm.sketch`): seen once, seen twice.
2. Lines whose key may have been seen in two documents are *suspected*. Only
   these are shuffled, with their key: documents per key are counted exactly
   (combined before the shuffle, so a line in a third of all documents sends
   one row a task) and the largest ``doc_id`` is chosen.
3. The line numbers to drop are joined back to their documents.

Defined results: a null text is one empty line. Null ``doc_id`` rows count as
one document that comes before all others. Rows that repeat a ``doc_id`` are
one document. An empty table gives an empty result. Columns beside ``doc_id``
and ``text`` are kept, but for those named as an output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import BLANKS, batch_of, carried, small_batches, stage, text_hash
from comptoir.llm.sketch import LOG2_WORDS, holds, twice_filter


def keys_of(text: str | None, min_chars: int) -> dict[bytes, list[int]]:
    """Line numbers by key, for keys that are long enough."""
    out: dict[bytes, list[int]] = {}
    for i, line in enumerate((text or "").split("\n")):
        if len(line) >= min_chars and len(key := line.strip(BLANKS)) >= min_chars:
            out.setdefault(key.encode().lower(), []).append(i)
    return out


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                   log2_words: int = LOG2_WORDS) -> DataFrame:
    """(doc_id, th, lines): the line numbers that each document loses."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", text_hash().alias("th"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashes(b: pa.RecordBatch):
        for text in b.column("text").to_pylist():
            yield _hashes(keys_of(text, min_chars))

    seen = twice_filter(rows.select("text"), hashes, log2_words)

    def suspects(batches):
        for b in batches:
            at, keys, lines = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                found = keys_of(text, min_chars)
                at += [i] * len(found)
                keys += found
                lines += found.values()
            hit = np.flatnonzero(holds(*seen.value, _hashes(keys)))
            if hit.size:
                of = pa.array(np.asarray(at, np.int64)[hit])
                yield batch_of({"doc_id": (b.column("doc_id").take(of), None), "th": (b.column("th").take(of), None),
                                "key": ([keys[i] for i in hit], pa.binary()),
                                "lines": ([lines[i] for i in hit], pa.list_(pa.int32()))})

    schema = f"doc_id {kind}, th bigint, key binary, lines array<int>"
    suspected = stage(rows.mapInArrow(suspects, schema), "suspected_lines")
    # Staged, so that the join below shuffles both sides and Spark can split a hot key.
    repeats = stage(suspected.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
                    .groupBy("key").agg(F.count("one").alias("n"), F.max("doc_id").alias("keeper"))
                    .where(F.col("n") >= min_docs), "repeated_keys")
    return (suspected.join(repeats, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "th").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines")))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, log2_words: int = LOG2_WORDS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``."""
    drops = repeated_lines(docs, min_chars, min_docs, log2_words).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("lines").alias("__lines"))
    lines = F.split(F.coalesce(docs["text"], F.lit("")), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lines"))
    # As an element of an array the lines are split once a document, not once for each line that stays.
    both = F.array(F.struct(lines.alias("lines"), left.alias("left")))
    kept = F.get(F.transform(both, lambda d: F.array_join(F.transform(d["left"], lambda i: F.get(d["lines"], i)), "\n")), F.lit(0))
    whole = F.col("__lines").isNull()
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops["__id"]) & (F.xxhash64(docs["text"]) == drops["__th"]),
                       "left")
    return joined.select(
        *carried(docs, ["n_lines", "n_dropped", "kept_text"]), F.size(lines).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("__lines")).cast("long").alias("n_dropped"),
        F.when(whole, F.coalesce(docs["text"], F.lit(""))).otherwise(kept).alias("kept_text"))
