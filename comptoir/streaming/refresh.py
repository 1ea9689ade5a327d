"""Continuous refresh as a Structured Streaming query.

The source system polls every 60 seconds and recomputes everything. Here a
stream of *change notices* (one row per landed change: tenant_id, table,
landed_at) drives micro-batches; each batch recomputes the reports of the
tenants it touched, reading only their replica partitions (semi-join on
tenant_id over tenant-partitioned parquet), and replaces their snapshots.

Per-tenant top-N is not expressible on a streaming DataFrame (only time
windows are), so the work happens in ``foreachBatch`` on static DataFrames.
The batch id is the cycle number, and the query's id with it the run id: a new checkpoint is a
new query, whose batches hide no earlier cycle. The checkpoint (under the shared
checkpoint folder by default) makes a restarted query resume after the last
completed batch. Snapshot writes replace partitions, so a batch run twice
after a failure leaves the same result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from comptoir.functions.labels import MODULE_KEYS
from comptoir.plans.cycle import refresh_cycle
from comptoir.session import ensure_checkpoint_dir
from comptoir.sources.replica import load_replica

CHANGES_SCHEMA = T.StructType([
    T.StructField("tenant_id", T.StringType(), False),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("landed_at", T.TimestampNTZType(), True),
])

DEFAULT_INTERVAL = "60 seconds"


def stream_checkpoint(spark: SparkSession, out_root: str) -> str:
    """The checkpoint folder of the stream that writes to ``out_root``."""
    key = hashlib.sha1(out_root.rstrip("/").encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/comptoir/stream/{key}"


def refresh_stream(spark: SparkSession, changes_path: str, replica_path: str, out_root: str,
                   settings, interval: str | None = DEFAULT_INTERVAL, available_now: bool = False,
                   checkpoint: str | None = None, registry_path: str | None = None,
                   modules: list[str] = MODULE_KEYS, max_files_per_trigger: int | None = None,
                   load=load_replica) -> StreamingQuery:
    """Start the refresh query; ``available_now`` processes what has landed and stops (tests, catch-up).

    ``settings`` is a table or a function that reads it, called for every batch. The default checkpoint
    belongs to ``out_root``: started again for the same output, the query goes on where it stopped. ``load`` reads the
    replica: :func:`~comptoir.sources.replica.load_replica`, or :func:`~comptoir.sources.ledger.open_ledger`.
    """
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(CHANGES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = reader.parquet(changes_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select("tenant_id").where(F.col("tenant_id").isNotNull()).distinct().checkpoint()
        if touched.isEmpty():
            return
        # Set by the query that runs the batch; it stays the same as long as the checkpoint does.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or where
        refresh_cycle(spark, lambda: load(spark, replica_path, tenants=touched), out_root, batch_id, settings,
                      tenants=touched, modules=modules, registry_path=registry_path, run_id=f"stream-{query}-{batch_id}")

    where = checkpoint or stream_checkpoint(spark, out_root)
    w = (changes.writeStream.foreachBatch(run)
         .option("checkpointLocation", where))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
