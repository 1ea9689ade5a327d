"""Sharding by fixed virtual slots (operator 4). DataFrame functions only.

Records are hashed by ``doc_id`` into ``SLOTS`` virtual slots. A versioned table
maps slots to shards; records never move but with their slot. The first map
places the slots, heaviest first, on the shard with the fewest bytes so far. When
shards are added, :func:`grow_map` writes the next version: it takes just
enough slots from the shards above the new mean and gives them to the new ones;
all others stay.

A map has ``SLOTS`` rows at any data size, so it is folded in one expression
and broadcast. Slot bytes are combined before the shuffle.

Rows are numbered within their shard (``slot`` of the query) in two levels:
counts per block of at most ``BLOCK_ROWS`` stored rows, then positions inside a
block, so no task holds a shard.

Defined results: a null text has size 1 and the checksum of no bytes. A record without
``doc_id`` is hashed by its text. Repeated rows are records of their own, in the same slot.
An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from comptoir.llm.common import stage

SLOTS = 4096
BLOCK_ROWS = 100_000


def virtual_slot(slots: int = SLOTS) -> Column:
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return F.pmod(key, F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), virtual_slot(slots).alias("virtual_slot"))


def slot_bytes(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes) of every slot, 0 for empty ones."""
    full = recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(full, "virtual_slot", "left").select("virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def first_map(weights: DataFrame, shards: int) -> DataFrame:
    """Version 1: (version, virtual_slot, shard, bytes). Heaviest slot first, each to the lightest shard."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "bytes")))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
                     F.array().cast("array<int>").alias("shards"))

    def place(done: Column, slot: Column) -> Column:
        to = (F.array_position(done["loads"], F.array_min(done["loads"])) - 1).cast("int")
        loads = F.transform(done["loads"], lambda x, i: F.when(i == to, x + slot["bytes"]).otherwise(x))
        return F.struct(loads.alias("loads"), F.concat(done["shards"], F.array(to)).alias("shards"))

    folded = (weights.agg(order.alias("slots"))
              .select("slots", F.aggregate("slots", start, place)["shards"].alias("shards")))
    return (folded.select(F.explode(F.arrays_zip("slots", "shards")).alias("x"))
            .select(F.lit(1).alias("version"), F.col("x.slots.virtual_slot").alias("virtual_slot"),
                    F.col("x.shards").alias("shard"), F.col("x.slots.bytes").alias("bytes")))


def grow_map(old: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for ``shards`` shards, more than it has: slots move only to the new ones."""
    now = old.drop("bytes").join(weights, "virtual_slot")
    had = F.max("shard").over(Window.partitionBy(F.lit(0))) + 1  # a map's rows are few
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards
    by_shard = Window.partitionBy("shard")
    # Within a shard slots go while it stays at or above the mean without them.
    left = F.sum("bytes").over(by_shard) - F.sum("bytes").over(
        by_shard.orderBy(F.xxhash64("virtual_slot"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    moved = now.withColumn("had", had).withColumn("go", left >= mean)
    nth = F.row_number().over(Window.partitionBy("go").orderBy(F.desc("bytes"), "virtual_slot")) - 1
    to = F.col("had") + F.pmod(nth, F.lit(shards) - F.col("had"))
    return moved.select((F.col("version") + 1).alias("version"), "virtual_slot",
                        F.when(F.col("go"), to).otherwise(F.col("shard")).cast("int").alias("shard"), "bytes")


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored map; older versions stay, so any one can be read again."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the latest by default."""
    maps = spark.read.schema("virtual_slot int, shard int, bytes long, version int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("version", "virtual_slot", "shard", "bytes")


def assign(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``recs`` with ``shard`` and ``version``. A map has a fixed number of rows and is broadcast."""
    return recs.join(F.broadcast(slot_map.select("virtual_slot", "shard", "version")), "virtual_slot")


def number_rows(stored: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``stored`` (a staged table with a column shard) with ``slot``: 0, 1, 2, ... within each shard."""
    at = stored.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    at = at.withColumn("__block", F.floor(F.col("__row") / block_rows))
    block = ["shard", "__file", "__block"]
    counts = at.groupBy(*block).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__file", "__block")) - F.col("__n")
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("__row")) - 1
    return (at.withColumn("__i", inside).join(counts.select(*block, before.alias("__before")), block)
            .withColumn("slot", (F.col("__i") + F.col("__before")).cast("long"))
            .drop("__file", "__row", "__block", "__i", "__before"))


def shard_records(docs: DataFrame, shards: int, map_path: str, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, version, shard, slot) of every row; version 1 of the map goes to ``map_path``."""
    recs = stage(records(docs, slots), "records")
    save_map(first_map(slot_bytes(recs, slots), shards), map_path)
    return number_rows(stage(assign(recs, load_map(docs.sparkSession, map_path)), "sharded"))
