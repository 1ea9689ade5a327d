"""Top-N rows per tenant.

``row_number() OVER (PARTITION BY tenant_id ORDER BY ...) <= n`` directly
over the window lets Catalyst plan a partial ``WindowGroupLimit`` before the
shuffle: every map task keeps at most ``n`` rows per tenant, so a tenant that
holds a third of the data ships ``n`` rows per task, not its whole share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "rn"


def top_n(df: DataFrame, order: list[Column], n: int, by: tuple[str, ...] = ("tenant_id",)) -> DataFrame:
    """Keep the first ``n`` rows of each ``by`` group under ``order`` (which must be total); adds ``rn``."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) <= n)
