"""Tenant registry: upsert (activation), and its storage partitioned by tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.schemas import REGISTRY_SCHEMA

SET_COLUMNS = ["hw_id", "status", "updated_at"]


def upsert_registry(registry: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert or update registry rows by ``tenant_id``.

    For a tenant in ``updates`` the set columns (hw_id, status, updated_at)
    take the new values, null included; its other columns are kept (null for
    a new tenant). Several updates for one tenant: the latest ``updated_at``
    wins (ties broken by the other set columns).
    """
    u = (updates.groupBy("tenant_id")
         .agg(F.max(F.struct("updated_at", "hw_id", "status")).alias("u")))
    j = registry.join(u, "tenant_id", "full")
    new = F.col("u").isNotNull()
    return j.select(
        "tenant_id",
        *[F.when(new, F.col(f"u.{c}")).otherwise(F.col(c)).alias(c) for c in SET_COLUMNS],
        "last_sync_duration_ms", "last_sync_error")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry stored by :func:`write_registry`, in schema column order."""
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path).select(*REGISTRY_SCHEMA.fieldNames())


def write_registry(df: DataFrame, path: str) -> None:
    """Store registry rows partitioned by tenant, replacing only the tenants in ``df``.

    A failed write can only touch those tenants' partitions; the other tenants' rows are never rewritten.
    """
    (df.select(*REGISTRY_SCHEMA.fieldNames()).repartition("tenant_id").write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("tenant_id").parquet(path))
