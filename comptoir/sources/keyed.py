"""Replica tables kept from change rows: the latest row of each key, deletions included (O1, O4, O9).

A *change row* has the table's columns, a sequence number (``change_seq``) and a tombstone flag (``deleted``). Of all change
rows of a key the one with the highest sequence number counts, whenever it arrives: a late row loses against what is stored, a
repeated row changes nothing, and a deleted key stays as a tombstone, so that a late row does not bring it back. With equal
numbers a deletion wins, then the row with the larger hash. Waves may therefore be cut, repeated and ordered in any way.

Stored under ``path`` are

* ``rows/version=V/tenant_id=T/slot=S``: the rows and tombstones of a tenant whose key hash falls into a slot;
* ``commits``: per wave and slot that it wrote, the version that holds the slot now and its number of rows.

A wave rewrites the slots that its keys fall into and no others. Its files count once ``commits`` names their version; that
is one file, written last, so a wave that was cut off is not seen and is simply applied again.

The number of slots is a tenant's own, a power of two for about ``slot_rows`` rows a slot, so a tenant with a third of all rows has
many and a small one has one. When a tenant has outgrown its slots twofold, the wave that finds this rewrites the tenant with more.

Files are never replaced or removed, so rows opened before a wave stay readable as they were. There is one writer at a time. Keys are compared as stored; a row without tenant, key or sequence number has no place
here: :func:`split_keyed` diverts such rows, ``apply`` refuses them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comptoir.schemas import REPLICA_KEYS, REPLICA_SCHEMAS
from comptoir.session import scratch_path

#: Only tables with a key in the data contract can be kept by it.
KEYS = REPLICA_KEYS
SLOT_ROWS = 1_000_000
#: Slots that are named to the scan one by one (a filter on folders); more of them are found by a join.
PRUNED_SLOTS = 100_000
PAIR = ["tenant_id", "slot"]
COMMITS = "seq bigint, tenant_id string, slots int, slot int, version string, n_rows bigint"
CHANGE = T.StructType([T.StructField("change_seq", T.LongType()), T.StructField("deleted", T.BooleanType())])


def _missing(key: list[str]) -> Column:
    """The names of the key columns that a change row lacks (an empty tenant id can't be told from none on storage)."""
    return F.concat_ws(",", *(F.when(F.col(c).isNull() | ((F.col(c) == "") if c == "tenant_id" else F.lit(False)), F.lit(c))
                              for c in [*key, "change_seq"]))


def split_keyed(changes: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Change rows with tenant, key and sequence number, and those without, with ``rejected_columns``."""
    marked = changes.withColumn("rejected_columns", _missing(key))
    return marked.where("rejected_columns = ''").drop("rejected_columns"), marked.where("rejected_columns <> ''")


class KeyedTable:
    """The rows of one table by key, kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], slot_rows: int = SLOT_ROWS):
        if key[0] != "tenant_id":
            raise ValueError("the key starts with tenant_id")
        self.spark, self.path, self.key, self.slot_rows = spark, path.rstrip("/"), key, slot_rows
        self.columns = schema.fieldNames()
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.stored = T.StructType([*self.schema.fields, *CHANGE.fields])
        self.values = [c for c in self.stored.fieldNames() if c not in key]

    @classmethod
    def of_replica(cls, spark: SparkSession, path: str, table: str, slot_rows: int = SLOT_ROWS) -> KeyedTable:
        return cls(spark, f"{path.rstrip('/')}/{table}", REPLICA_SCHEMAS[table], KEYS.get(table, ["tenant_id"]), slot_rows)

    # -- reading ------------------------------------------------------------------
    def _read(self, folder: str, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def slots(self) -> DataFrame:
        """The current slots, one row each: (tenant_id, slots, slot, version, n_rows)."""
        every = self._read("commits", COMMITS)
        # Slots only become more, so the largest number is a tenant's current one.
        now = every.groupBy("tenant_id").agg(F.max("slots").alias("slots"))
        return (every.join(now, ["tenant_id", "slots"]).groupBy("tenant_id", "slots", "slot")
                .agg(F.max_by(F.struct("version", "n_rows"), "seq").alias("at"))
                .select("tenant_id", "slots", "slot", "at.*"))

    def _rows_of(self, slots: DataFrame) -> DataFrame:
        """The stored rows of ``slots``, tombstones included, reading only their folders."""
        schema = T.StructType([*self.stored.fields, T.StructField("version", T.StringType()), T.StructField("slot", T.IntegerType())])
        rows, place = self._read("rows", schema), ["version", *PAIR]
        named = slots.select(*place).limit(PRUNED_SLOTS + 1).collect()
        if len(named) <= PRUNED_SLOTS:
            rows = rows.where(F.concat_ws("\x1f", *place).isin(["\x1f".join(map(str, r)) for r in named]))
        else:
            rows = rows.join(slots.select(*place), place, "left_semi")
        return rows.select(*self.stored.fieldNames())

    def rows(self) -> DataFrame:
        """The table as it is now."""
        return self._rows_of(self.slots()).where(~F.col("deleted")).select(*self.columns)

    # -- writing ------------------------------------------------------------------
    def _latest(self, rows: DataFrame, by: list[str]) -> DataFrame:
        """One row a key: the latest (see above). Combines before the shuffle, so a key with many rows is no hot group."""
        order = F.struct("change_seq", "deleted", F.xxhash64(*self.values))
        return (rows.groupBy(*by, *self.key).agg(F.max_by(F.struct(*self.values), order).alias("v"))
                .select(*by, *self.key, "v.*").select(*by, *self.stored.fieldNames()))

    def _placed(self, rows: DataFrame, layout: DataFrame) -> DataFrame:
        """``rows`` with their slot among the tenant's."""
        return (rows.join(layout.select("tenant_id", "slots"), "tenant_id")
                .withColumn("slot", F.pmod(F.xxhash64(*self.key), F.col("slots")).cast("int")))

    def apply(self, changes: DataFrame) -> str | None:
        """Merge a wave of change rows; returns the version that holds the slots it wrote (None: an empty wave)."""
        ready = changes.select(*self.columns, F.col("change_seq").cast("long").alias("change_seq"),
                               F.coalesce(F.col("deleted").cast("boolean"), F.lit(False)).alias("deleted"))
        if not ready.where(_missing(self.key) != "").isEmpty():
            raise ValueError("change rows without tenant, key or sequence number; see split_keyed")
        wave = self._staged(self._latest(ready, []), "wave")
        live = self.slots().checkpoint()
        # One row a tenant of the wave: its slots now (null: a new tenant) and after the wave.
        held = live.groupBy("tenant_id").agg(F.max("slots").alias("was"), F.sum("n_rows").alias("held"))
        total = F.coalesce("held", F.lit(0)) + F.col("arriving")
        fitting = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(total / F.lit(self.slot_rows))))).cast("int")
        layout = (wave.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("arriving")).join(held, "tenant_id", "left")
                  .select("tenant_id", "was", F.when(F.col("was").isNull() | (total > 2 * self.slot_rows * F.col("was")),
                                                     F.greatest(F.coalesce("was", F.lit(1)), fitting))
                          .otherwise(F.col("was")).alias("slots"))).checkpoint()
        if layout.isEmpty():
            return None
        placed = self._placed(wave, layout)
        touched = placed.select(*PAIR).distinct()
        grown = layout.where("was < slots").select("tenant_id")
        old = live.join(touched.join(grown, "tenant_id", "left_anti"), PAIR, "left_semi").unionByName(
            live.join(grown, "tenant_id", "left_semi"))
        stored = self._placed(self._rows_of(old), layout)
        # The slots are bounded, so they are the unit of the shuffle, and the merge needs no second one.
        merged = self._latest(placed.unionByName(stored).repartition(*PAIR), ["slots", "slot"])
        every = layout.join(grown, "tenant_id").select("tenant_id", "slots", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
        wrote = touched.join(layout, "tenant_id").select("tenant_id", "slots", "slot").unionByName(every).distinct()
        return self._write(merged, wrote)

    def replace(self, rows: DataFrame, seq: int, spread: list[str]) -> str | None:
        """For tables without a key: ``rows`` become all rows of the tenants that they are of, but for tenants that have rows of
        a later ``seq``. A tenant's rows are one slot here, written by many tasks, each a range of ``spread``."""
        later = self._rows_of(self.slots()).where(F.col("change_seq") > seq).select("tenant_id").distinct()
        rows = rows.select(*self.columns).join(later, "tenant_id", "left_anti")
        wrote = rows.select("tenant_id", F.lit(1).alias("slots"), F.lit(0).alias("slot")).distinct().checkpoint()
        if wrote.isEmpty():
            return None
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self._write(rows.withColumns({"change_seq": F.lit(seq).cast("long"), "deleted": F.lit(False), "slot": F.lit(0)})
                           .repartitionByRange(n, *spread), wrote)

    def forget(self, before_seq: int) -> str | None:
        """Drop tombstones older than ``before_seq``: once no row older than that can arrive any more."""
        live = self.slots().checkpoint()
        is_old = F.col("deleted") & (F.col("change_seq") < before_seq)
        layout = live.select("tenant_id", "slots").distinct()
        wrote = self._placed(self._rows_of(live).where(is_old), layout).select("tenant_id", "slots", "slot").distinct().checkpoint()
        if wrote.isEmpty():
            return None
        kept = self._rows_of(live.join(wrote, ["tenant_id", "slots", "slot"], "left_semi")).where(~is_old)
        return self._write(self._placed(kept, layout).repartition(*PAIR), wrote)

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, "keyed", name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _write(self, rows: DataFrame, wrote: DataFrame) -> str:
        """Store ``rows`` as the contents of the slots ``wrote``, then commit."""
        version = uuid.uuid4().hex
        folder = f"{self.path}/rows/version={version}"
        (rows.select(*self.stored.fieldNames(), "slot").write.partitionBy(*PAIR).parquet(folder))
        back = self.spark.read.schema(T.StructType([T.StructField("tenant_id", T.StringType()), T.StructField("slot", T.IntegerType())]))
        counts = back.parquet(folder).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_rows"))
        seq = (self._read("commits", COMMITS).agg(F.max("seq")).first()[0] or 0) + 1
        (wrote.join(counts, PAIR, "left")
         .select(F.lit(seq).cast("long").alias("seq"), "tenant_id", "slots", "slot", F.lit(version).alias("version"),
                 F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))
         .coalesce(1).write.mode("append").parquet(f"{self.path}/commits"))
        return version
