"""Landing: what a tenant's database delivers becomes the replica (O1).

A delivery is cast to the fixed schema (:func:`~comptoir.sources.replica.conform`). Rows that fit are merged by key into a
:class:`~comptoir.sources.keyed.KeyedTable`; rows that don't, or that lack a key, are kept as delivered under
``_rejected/<table>/landing=N``, so that one bad value fails neither its table nor another tenant.

A delivery is either change rows or, with ``complete``, the table as it is: then stored keys that a delivered tenant no
longer has are deleted. A row that was delivered but rejected is not gone: its stored predecessor stays. A tenant that is
not delivered keeps what it has, so an unreachable database deletes nothing.

Landings are numbered; the number is the sequence number of rows that bring none. A landing that is repeated under its number
gives the same tables. Tables without a key (lines, stock, families: rows may repeat) are always landed complete and replace the
delivered tenants' rows.

Reading a large table from a database takes ranges of its key that hold about as many rows each: :func:`key_splits` takes their
bounds from a quantile sketch of the keys that an earlier landing stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.schemas import REPLICA_SCHEMAS
from comptoir.session import scratch_path
from comptoir.sources.keyed import CHANGE, KEYS, SLOT_ROWS, KeyedTable, split_keyed
from comptoir.sources.replica import SPREAD, conform

REJECTED = "_rejected"


def land(spark: SparkSession, delivered: DataFrame, table: str, root: str, landing: int, complete: bool = False,
         slot_rows: int = SLOT_ROWS) -> None:
    """Land one delivery of one table (of any number of tenants) under ``root``.

    ``delivered`` has the table's columns, of any type that casts to theirs, and may have ``change_seq`` and ``deleted``. Other columns
    are kept with rejected rows only.
    """
    if table not in KEYS and not complete:
        raise ValueError(f"{table} has no key: it is landed complete")
    # The delivery is read once: a database read twice may give two states.
    path = scratch_path(spark, "landing", table)
    delivered.write.parquet(path)
    delivered = spark.read.schema(delivered.schema).parquet(path)
    for name, default in (("change_seq", F.lit(landing)), ("deleted", F.lit(False))):
        kind = CHANGE[name].dataType
        given = F.coalesce(F.col(name).try_cast(kind), default) if name in delivered.columns else default
        delivered = delivered.withColumn(name, given.cast(kind))
    good, bad = conform(delivered, table, keep=CHANGE.fieldNames())
    good, unkeyed = split_keyed(good, KEYS.get(table, ["tenant_id"]))
    bad = bad.unionByName(unkeyed.select(*(F.col(c).cast(bad.schema[c].dataType).alias(c) for c in unkeyed.columns)),
                          allowMissingColumns=True)
    bad.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root.rstrip('/')}/{REJECTED}/{table}/landing={landing}")
    kept = KeyedTable.of_replica(spark, root, table, slot_rows)
    if table not in KEYS:
        kept.replace(good, landing, SPREAD[table])
        return
    if complete:
        good = good.unionByName(_gone(kept, delivered, landing))
    kept.apply(good)


def _gone(kept: KeyedTable, delivered: DataFrame, landing: int) -> DataFrame:
    """Tombstones for the stored keys that delivered tenants no longer have. Rejected rows count as delivered."""
    key, fields = kept.key, kept.schema
    there = delivered.select(*(F.col(c).try_cast(fields[c].dataType).alias(c) for c in key))
    stored = kept.rows().select(*key).join(there.select("tenant_id").distinct(), "tenant_id", "left_semi")
    gone = stored.join(there, key, "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields if f.name not in key]
    return (gone.select(*key, *empty, F.lit(landing).cast("long").alias("change_seq"), F.lit(True).alias("deleted"))
            .select(*kept.stored.fieldNames()))


def rejected(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rejected rows of every landing, as delivered, with ``rejected_columns`` and the number of the landing."""
    return spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{REJECTED}/{table}")


def open_landed(spark: SparkSession, root: str, tenants: DataFrame | None = None) -> dict[str, DataFrame]:
    """The replica that landings under ``root`` left; optionally only ``tenants`` (a DataFrame of tenant_id). A table
    without landing is empty. The tables stay as they are now, whatever is landed later."""
    out = {table: KeyedTable.of_replica(spark, root, table).rows() for table in REPLICA_SCHEMAS}
    if tenants is not None:
        out = {table: df.join(tenants.select("tenant_id"), "tenant_id", "left_semi") for table, df in out.items()}
    return out


def key_splits(rows: DataFrame, key: str, n: int) -> DataFrame:
    """(tenant_id, bounds): for each tenant up to ``n`` - 1 rising bounds of the whole-number ``key`` that cut its rows into
    parts of about equal size, however the keys are spread. From one quantile sketch a tenant, merged from the tasks' sketches; its
    rank error is a small part of a split. A key value that fills several splits gives one bound.
    """
    at = F.array(*[F.lit(i / n) for i in range(1, n)])
    sketch = F.kll_sketch_agg_bigint(F.col(key).cast("long"), F.lit(min(65535, max(200, 100 * n))))
    return (rows.where(F.col(key).isNotNull()).groupBy("tenant_id").agg(sketch.alias("sketch"))
            .select("tenant_id", F.array_distinct(F.kll_sketch_get_quantile_bigint("sketch", at)).alias("bounds")))


def split_predicates(key: str, bounds: list[int]) -> list[str]:
    """SQL conditions, one a split, that together take every row once (rows without key with the first)."""
    if not bounds:
        return ["1 = 1"]
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *middle, f"{key} >= {bounds[-1]}"]


def read_jdbc_splits(spark: SparkSession, url: str, table: str, tenant_id: str, properties: dict, key: str,
                     bounds: list[int]) -> DataFrame:
    """One tenant's table over JDBC, a task for each split of ``key`` (see :func:`key_splits`). Needs the database's driver."""
    cols = [c for c in REPLICA_SCHEMAS[table].fieldNames() if c != "tenant_id"]
    rows = spark.read.jdbc(url, table, predicates=split_predicates(key, bounds), properties=properties)
    return rows.select(F.lit(tenant_id).alias("tenant_id"), *cols)
