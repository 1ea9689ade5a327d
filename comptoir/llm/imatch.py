"""I-Match document fingerprints with randomised lexicons (operator 8). DataFrame functions only.

The lexicon has the terms whose inverse document frequency ln(n / df) lies in
[``IDF_LOW``, ``IDF_HIGH``], counted over all documents. Each of 16 lexicons keeps a
random part of it, from all to a 256th (``KEEPS_ONE_IN``), so that some are
sensitive and some robust. A document's distinct terms in a lexicon are sorted by
their 64-bit hash and hashed together, which gives 8 hex digits; ``--------`` stands for no
term. If a document has no term in the band, the first part hashes its lower-cased text.
The fingerprint is the 16 parts in a row, so equal texts have equal
fingerprints. The likeness of two fingerprints is the share of equal parts
among those where at least one has a term (1 for equal fingerprints).

Size of the lexicon: document frequencies add up to n times the mean number of
distinct terms, and each term in it has at least n / exp(IDF_HIGH), so it has at
most exp(IDF_HIGH) (2981) terms for each of the mean document, whatever n is.
So it may be broadcast.

One shuffle of the texts: they are dealt into ranges of ``doc_id``, and
neighbours, terms, fingerprints and likenesses are computed in that partitioning. The
first document of a range is dealt to the range above as well, as its last one's neighbour.

Defined results: a null text is empty. A null ``doc_id`` comes after all others in descending
order; rows that repeat a ``doc_id`` are ordered by text. A document that is its own neighbour (the
only one) is edited by its own beginning. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comptoir.llm.common import stage

IDF_LOW, IDF_HIGH = 1.0, 8.0
#: One lexicon keeps one term in so many.
KEEPS_ONE_IN = [1] + [4] * 3 + [16] * 4 + [64] * 4 + [256] * 4
ROWS_PER_RANGE = 1000
MOST_RANGES = 4096
EMPTY = "-" * 8
NULL_ID = -(1 << 63)


def terms(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits (and perhaps an empty string)."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def lexicon(docs: DataFrame, idf_low: float = IDF_LOW, idf_high: float = IDF_HIGH) -> DataFrame:
    """(term, h, lexicons): hash of each term in the band, and a bit for each lexicon that has it."""
    n = docs.count()
    df = docs.select(F.explode(terms(F.col("text"))).alias("term")).where("term <> ''").groupBy("term").count()
    band = df.where(F.col("count").between(n * math.exp(-idf_high), n * math.exp(-idf_low)))
    bits = F.lit(0)
    for i, one_in in enumerate(KEEPS_ONE_IN):
        drawn = F.pmod(F.xxhash64("term", F.lit(i)), F.lit(one_in)) == 0
        bits = bits + F.when(drawn, 1 << i).otherwise(0)
    return stage(band.select("term", F.xxhash64("term").alias("h"), bits.alias("lexicons")), "lexicon")


def in_lexicon(found: Column, i: int) -> Column:
    """Hashes of the terms that lexicon ``i`` keeps."""
    kept = F.filter(found, lambda x: x["lexicons"].bitwiseAND(F.lit(1 << i)) != 0)
    return F.transform(kept, lambda x: x["h"])


def _digits(x: Column) -> Column:
    return F.lower(F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def fingerprint(found: Column, whole: Column) -> Column:
    """From a sorted array of (h, lexicons) of the distinct terms, and a hash of the whole text."""
    parts = [F.when(F.size(found) == 0, _digits(whole)).otherwise(_digits(F.xxhash64(in_lexicon(found, 0))))]
    for i in range(1, len(KEEPS_ONE_IN)):
        mine = in_lexicon(found, i)
        parts.append(F.when(F.size(mine) == 0, EMPTY).otherwise(_digits(F.xxhash64(mine))))
    return F.concat(*parts)


def likeness(a: Column, b: Column) -> Column:
    same = either = F.lit(0)
    for i in range(len(KEEPS_ONE_IN)):
        x, y = F.substring(a, 8 * i + 1, 8), F.substring(b, 8 * i + 1, 8)
        some = (x != EMPTY) | (y != EMPTY)
        either = either + some.cast("int")
        same = same + (some & (x == y)).cast("int")
    return F.when(a == b, F.lit(1.0)).otherwise(same / either)


def in_ranges(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE, most_ranges: int = MOST_RANGES) -> DataFrame:
    """(range, copied, id, doc_id, text): every row in its range of ids, and the row that follows each range, copied.

    Range bounds are quantiles of the ids (at most ``most_ranges`` numbers).
    """
    ids = stage(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id")), "ids")
    n = min(most_ranges, max(1, ids.count() // rows_per_range))
    cuts = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        cuts = sorted(set(ids.agg(F.percentile_approx("id", at, 100 * n)).first()[0]))
    # How many bounds are below an id: first among every 64th, then among the 64 from there on.
    bounds = F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    coarse = F.lit(cuts[63::64]).cast("array<bigint>") if cuts[63::64] else F.array().cast("array<bigint>")

    def range_of(x: Column) -> Column:
        block = F.size(F.filter(coarse, lambda c: c < x)) * 64
        return block + F.size(F.filter(F.slice(bounds, block + 1, 64), lambda c: c < x))

    heads = stage(ids.groupBy(range_of(F.col("id")).alias("range")).agg(F.max("id").alias("head")), "heads")
    # Descending order goes on from a range in the one below: its head is dealt to the range above it too.
    above = F.coalesce(F.lead("range").over(Window.partitionBy(F.lit(0)).orderBy("range")),
                       F.min("range").over(Window.partitionBy(F.lit(0))))  # a row a range
    copies = heads.select("head", above.alias("also"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "doc_id",
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(copies), F.col("id") == F.col("head"), "left")
    own = F.struct(range_of(F.col("id")).alias("range"), F.lit(False).alias("copied"))
    also = F.struct(F.col("also").alias("range"), F.lit(True).alias("copied"))
    return rows.select(F.explode(F.when(F.col("head").isNull(), F.array(own)).otherwise(F.array(own, also))).alias("at"),
                       "id", "doc_id", "text").select("at.range", "at.copied", "id", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, idf_low: float = IDF_LOW, idf_high: float = IDF_HIGH,
                          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the last third of the characters replaced by the beginning of the next document's.
    """
    words = lexicon(docs, idf_low, idf_high)
    order = Window.partitionBy("range").orderBy("copied", F.desc("id"), "text")
    rows = in_ranges(docs, rows_per_range).select(
        "*", F.row_number().over(order).alias("nth"), F.lead("text").over(order).alias("after"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.withColumns({"n_chars": n, "edited": F.concat(
        F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))"),
        F.substring(F.coalesce("after", F.lit("")), F.lit(1), third))})
    # A row for each of the two texts' terms, and one of the document itself; a copied row needs its own terms only.
    none = F.lit(None).cast("string")
    body = lambda kind, text, sha: F.struct(F.lit(kind).alias("kind"), text.alias("body"), F.xxhash64(F.lower(text)).alias("whole"),
                                             sha.alias("sha"))
    bodies = F.array(body(0, F.col("text"), none), body(1, F.when(~F.col("copied"), F.col("edited")), none),
                     body(2, none, F.sha2("edited", 256)))
    one = (rows.select("range", "nth", "copied", "id", "doc_id", "n_chars", F.explode(bodies).alias("b"))
           .select("range", "nth", "copied", "id", "doc_id", "n_chars", "b.kind", "b.whole", "b.sha",
                   F.explode_outer(terms(F.col("b.body"))).alias("term")))
    found = one.join(F.broadcast(words), "term", "left")
    entry = F.struct("h", "lexicons")
    of = lambda kind: F.collect_list(F.when((F.col("kind") == kind) & F.col("h").isNotNull(), entry))
    whole = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("whole")))
    made = (found.groupBy("range", "nth").agg(
        F.first("copied").alias("copied"), F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
        F.max("sha").alias("edited_sha256"), whole(0).alias("own_hash"), whole(1).alias("changed_hash"),
        F.array_sort(of(0)).alias("own"), F.array_sort(of(1)).alias("changed"))
        .select("range", "nth", "copied", "doc_id", "n_chars", "edited_sha256",
                fingerprint(F.col("own"), F.col("own_hash")).alias("fingerprint"),
                fingerprint(F.col("changed"), F.col("changed_hash")).alias("edited_fingerprint")))
    after = F.lead("fingerprint").over(Window.partitionBy("range").orderBy("nth"))
    return (made.withColumn("after", after).where(~F.col("copied"))
            .select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint",
                    "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("after")).alias("near_next")))
