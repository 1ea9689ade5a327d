"""Mixing sources to target weights (operator 12). DataFrame functions only.

1. A document's size is its number of words (runs without the six ASCII white-space characters). Sizes and
   draws are computed once and staged; no text is shuffled. Sizes add up by source, combined before the shuffle,
   so a source with a third of all rows sends one row a task.
2. Sources in code point order, null last, get the weights in turn. Each source's target is its share of all words by weight, at
   most ``most_repeats`` times its own; what a source can't take is shared again by weight until none is above.
   That fixed point is min(weight * level, most_repeats * size) with one level for all: it is
   found by adding up, again and again, what is left for the sources still below. Each round is one aggregate;
   the driver sees two sums.
3. A source's repetition rate is target / size. A document is taken floor(rate) times, and once more if its draw,
   a number in [0, 1) from a hash of its id and text, is below the fraction.
4. The hash gives ``SEEDS`` independent draws. A source uses the one whose words come nearest to its target (the first
   of several), which is one more sum by source. Whatever the seed, a draw says nothing of the document, so a
   fraction of the documents is taken, and the sum is several times nearer than a single seed's.

Defined results: a null or empty text has size 0 and is taken 0 words, however many copies. A source without words has target 0
and no copies. Rows that repeat id and text draw alike. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from comptoir.llm.common import carried, stage

SEEDS = 8  # draws of 8 hexadecimal digits in a SHA-256
MOST_ROUNDS = 1000


def words(text: Column) -> Column:
    """The number of runs without white space: each is cut down to one mark, then the marks are counted."""
    marks = F.translate(F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.char_length(marks), F.lit(0)).cast("long")


def draws() -> Column:
    """The hash of id and text that all draws of a document come from (null id: no id)."""
    return F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                           F.coalesce(F.col("text"), F.lit(""))), 256)


def draw(hashed: Column, seed: Column) -> Column:
    """Draw number ``seed`` in [0, 1)."""
    return F.conv(F.substring(hashed, seed * 8 + 1, F.lit(8)), 16, 10).cast("double") / F.lit(2.0 ** 32)


def copies(rate: Column, drawn: Column) -> Column:
    """How often a document is taken."""
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")).cast("long")


def weighted(sources: DataFrame, weights: list[int]) -> DataFrame:
    """``sources`` (source, source_size; any number) with ``weight``: the weights in turn, by code point, null last.

    A source's place is its place in a range partition plus the sources in the partitions before, so
    no task holds all sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    # The counts and the places need the same partitions, so these are staged.
    dealt = stage(sources.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("*", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("k")), "sources")
    parts = dealt.groupBy("p").agg(F.min("k").alias("k0"), F.count("*").alias("m"))
    before = F.sum("m").over(Window.orderBy("p")) - F.col("m")  # a row for each partition
    place = F.col("before") + F.col("k") - F.col("k0")
    turn = F.array(*(F.lit(w) for w in weights))
    return (dealt.join(parts.select("p", "k0", before.alias("before")), "p")
            .select("source", "source_size", F.get(turn, F.pmod(place, F.lit(len(weights))).cast("int")).cast("long").alias("weight")))


def level_of(sources: DataFrame, most_repeats: int) -> float:
    """The level at which min(weight * level, most_repeats * size) adds up to all words (0 without words)."""
    total = sources.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    if not total["t"]:
        return 0.0
    level = total["t"] / total["w"]
    for _ in range(MOST_ROUNDS):
        full = F.col("weight") * F.lit(level) > most_repeats * F.col("source_size")
        r = sources.agg(F.sum(F.when(full, most_repeats * F.col("source_size")).otherwise(0)).alias("taken"),
                        F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("w")).first()
        new = (total["t"] - r["taken"]) / r["w"]  # some source is below: all full ones together exceed the total
        if new == level:
            break
        level = new
    return level


def mixture(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_repeats: int = 3) -> tuple[DataFrame, DataFrame]:
    """(documents, sources), both staged.

    Documents: doc_id, source, size, draws. Sources: source, source_size, weight, target, rate, seed.
    """
    sized = stage(docs.select("doc_id", "source", words(F.col("text")).alias("size"), draws().alias("draws")), "sizes")
    shares = stage(weighted(sized.groupBy("source").agg(F.sum("size").alias("source_size")), list(weights)), "weights")
    level = F.lit(level_of(shares, most_repeats))
    most = (most_repeats * F.col("source_size")).cast("double")
    target = F.least(F.col("weight") * level, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = stage(shares.withColumn("target", target).withColumn("rate", rate), "rates")
    tried = (_by_source(sized, rated.select("source", "rate"))
             .select("source", *((copies(F.col("rate"), draw(F.col("draws"), F.lit(i))) * F.col("size")).alias(f"s{i}")
                                 for i in range(SEEDS)))
             .groupBy("source").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(SEEDS))))
    far = F.array(*(F.struct(F.abs(F.col(f"s{i}") - F.col("target")).alias("far"), F.lit(i).alias("seed")) for i in range(SEEDS)))
    chosen = _by_source(rated, tried).select(*rated.columns, F.array_min(far)["seed"].alias("seed"))
    return sized, stage(chosen, "mixture")


def _by_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """An inner join by source, null too. Spark broadcasts ``right`` if it is small, else it may split a hot source."""
    named = right.withColumnRenamed("source", "__source")
    return left.join(named, left["source"].eqNullSafe(named["__source"])).drop("__source")


def taken(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): how often every document is taken."""
    both = _by_source(sized, sources)
    return both.select("doc_id", "source", "size", "source_size", "target",
                       copies(F.col("rate"), draw(F.col("draws"), F.col("seed"))).alias("copies"))


def emit(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken, numbered by ``copy`` (1, 2, ...). No text is
    shuffled unless there are too many sources to broadcast."""
    plan = sources.select(F.col("source").alias("__source"), F.struct("rate", "seed").alias("__plan"))
    both = docs.join(plan, docs["source"].eqNullSafe(plan["__source"]))
    n = copies(F.col("__plan.rate"), draw(F.sha2(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"),
                                                          F.coalesce(docs["text"], F.lit(""))), 256), F.col("__plan.seed")))
    return both.select(*carried(docs, ["copy"]), F.explode(F.when(n > 0, F.sequence(F.lit(1).cast("long"), n))
                                                           .otherwise(F.array().cast("array<bigint>"))).alias("copy"))
