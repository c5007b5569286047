"""Delivery batches and metrics as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.constants import METRICS_NAMESPACE


def write_delivery_batches(batches: DataFrame, path: str, mode: str = "append") -> None:
    """Batches below one folder per tenant; rebalancing keeps a hot tenant in many files, a cold one in few."""
    batches.hint("rebalance", "tenant_id").write.mode(mode).partitionBy("tenant_id").parquet(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "append") -> None:
    """Appends metric rows (ts, tenant, metric, value, unit); no rows add no data."""
    metrics.withColumn("namespace", F.lit(METRICS_NAMESPACE)).write.mode(mode).parquet(path)
