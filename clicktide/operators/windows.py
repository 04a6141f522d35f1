"""Tumbling click counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(clicks: DataFrame, duration: str = "5 seconds") -> DataFrame:
    """Clicks per product and epoch-aligned window [start, end); NULL click ids are not counted.

    The counts are pre-aggregated in each map task, so a hot product sends one row per task and window.
    """
    return (
        clicks.groupBy(F.window("event_ts", duration).alias("w"), "product_id")
        .agg(F.count("click_id").alias("num_clicks"))
        .select(
            "product_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "num_clicks",
        )
    )
