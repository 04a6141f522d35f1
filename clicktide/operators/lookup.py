"""Lookup join of an event stream with a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.operators.skew import HOT_MIN_ROWS, HOT_SHARE, salt_all, split_hot_groups

# A dimension is broadcast up to this measured size. A broadcast goes through the driver, once per micro-batch.
BROADCAST_LIMIT = 16 * 1024 * 1024
# Cells per product when a streaming side meets a dimension of unknown or large size.
STREAM_SALTS = 8


def measured_bytes(dimension: DataFrame) -> int:
    """Row-format size of a dimension of string columns, counted by one aggregate over it."""
    per_row = F.lit(16 + 16 * len(dimension.columns))
    for name in dimension.columns:
        per_row = per_row + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return dimension.agg(F.sum(per_row.cast("bigint")).alias("n")).first()["n"] or 0


def lookup_join(
    events: DataFrame,
    products: DataFrame,
    products_bytes: int | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_share: float = HOT_SHARE,
    hot_min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Events with ``product_name, product_description, product_price`` of their product.

    Inner join on ``product_id``: events with an unknown or NULL product are dropped, and a product
    listed twice gives two rows.

    The dimension is broadcast only when its size is known to be within ``broadcast_limit``:
    ``products_bytes`` when the caller has measured it, else, for batch events, measured here. Beyond
    the limit both sides are shuffled, whatever size Spark's own estimate (that of compressed files) has, with the rows
    of hot products dealt over several tasks. Streaming
    events meet a dimension that is read anew for each micro-batch and may grow, so without
    ``products_bytes`` nothing is broadcast by force and every product's rows are dealt.
    """
    dimension = products.select(
        F.col("product_id").alias("_product_key"),
        "product_name",
        F.col("description").alias("product_description"),
        F.col("price").alias("product_price"),
    )
    if products_bytes is None and not events.isStreaming:
        products_bytes = measured_bytes(dimension)
    same_product = F.col("product_id") == F.col("_product_key")
    if products_bytes is not None and products_bytes <= broadcast_limit:
        joined = events.join(F.broadcast(dimension), same_product, "inner")
    elif events.isStreaming:
        left, right, same_cell = salt_all(events, dimension, events.columns, STREAM_SALTS)
        joined = left.join(right, same_product & same_cell, "inner")
    else:
        left, right, same_cell = split_hot_groups(
            events, dimension, ["product_id"], ["_product_key"], events.columns, dimension.columns,
            share=hot_share, min_rows=hot_min_rows,
        )
        joined = left.join(right.hint("merge"), same_product if same_cell is None else same_product & same_cell, "inner")
    return joined.select(*events.columns, "product_name", "product_description", "product_price")
