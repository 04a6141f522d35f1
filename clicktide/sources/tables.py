"""Clicks, checkouts and dimensions derived from an ``events`` / ``part`` / ``customer`` table set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide import schemas
from clicktide.functions.eventtime import processing_time

def events_table(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The whole events table, as a batch or replayed as a file stream.

    The stream takes all files as one micro-batch: they have no known order in event time, and rows of
    an earlier time in a later batch would be dropped as late.
    """
    if stream:
        # File streams take folders and patterns, not a single file's path.
        return spark.readStream.schema(schemas.EVENTS_TABLE).parquet(f"{sf_dir}/events.parque[t]")
    return spark.read.schema(schemas.EVENTS_TABLE).parquet(f"{sf_dir}/events.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _shape(events: DataFrame, kind: str, event_type: str, fields: dict[str, Column]) -> DataFrame:
    fields = {
        "user_id": _text("user_id"),
        "product_id": F.col("product"),
        "event_time": F.unix_micros(F.col("ts").cast("timestamp")) / 1e6,
        "enqueued_at": F.col("ts").cast("timestamp"),
        "partition_id": F.lit(0).cast("bigint"),
        "offset": F.col("event_id"),
        "topic_id": F.lit(kind),
        "proc_time": processing_time(),
        **fields,
    }
    names = schemas.EVENTS[kind].names + schemas.METADATA.names + schemas.PROC_TIME.names
    typed = events.where(F.col("event_type") == event_type)
    return typed.withColumn("product", F.get_json_object("props", "$.k")).select([fields[n].alias(n) for n in names])


def clicks_of(events: DataFrame) -> DataFrame:
    """Events of type ``click`` as click events."""
    return _shape(events, "clicks", "click", {
        "click_id": _text("event_id"),
        "product_url": F.concat(F.lit("https://shop.example/p/"), F.col("product")),
        "user_agent": F.concat(F.lit("agent-"), _text("user_id")),
        "ip": F.concat(F.lit("ip-"), _text("user_id")),
    })


def checkouts_of(events: DataFrame) -> DataFrame:
    """Events of type ``purchase`` as checkout events."""
    address = F.concat(F.lit("street "), _text("user_id"))
    return _shape(events, "checkouts", "purchase", {
        "checkout_id": _text("event_id"),
        "payment_method": F.when(F.col("value") >= 50, "Online Banking").otherwise("Cash"),
        "total_amount": F.format_string("$%.2f", "value"),
        "shipping_address": address,
        "billing_address": address,
        "user_agent": F.concat(F.lit("agent-"), _text("user_id")),
        "ip_address": F.concat(F.lit("ip-"), _text("user_id")),
    })


def products_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the products dimension."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat_ws(" ", "p_brand", "p_type").alias("description"),
        F.format_string("$%.2f", "p_retailprice").alias("price"),
    )


def users_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the users dimension."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        _text("c_custkey").alias("user_id"), F.col("c_name").alias("username")
    )
