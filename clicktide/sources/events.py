"""Event sources: a Kafka topic, or files holding the same columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide import schemas
from clicktide.functions.eventtime import processing_time

# A registry-framed Avro value starts with a zero byte and a four-byte schema id.
AVRO_FRAME_BYTES = 5

Decoder = Callable[[Column, str], Column]


def frame_body(value: Column) -> Column:
    """The Avro bytes behind the registry frame."""
    return F.substring(value, AVRO_FRAME_BYTES + 1, 2**31 - 1)


def decode_framed_avro(value: Column, kind: str) -> Column:
    """Registry-framed Avro bytes -> struct of the event's fields. Needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(frame_body(value), schemas.avro_schema(kind), {"mode": "FAILFAST"})


def decode_topic(raw: DataFrame, kind: str, decode: Decoder = decode_framed_avro) -> DataFrame:
    """Raw topic records -> the event's columns, broker metadata and processing time.

    The value carries every field, ``user_id`` included, so the key (the same user id) is not needed.
    """
    return raw.select(
        decode(F.col("value"), kind).alias("event"),
        F.col("timestamp").alias("enqueued_at"),
        F.col("partition").cast("bigint").alias("partition_id"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("topic").alias("topic_id"),
    ).select(
        *[f"event.{name}" for name in schemas.EVENTS[kind].names],
        *schemas.METADATA.names,
        processing_time().alias("proc_time"),
    )


def read_events(
    spark: SparkSession,
    kind: str,
    via: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    stream: bool = True,
    decode: Decoder = decode_framed_avro,
) -> DataFrame:
    """The ``clicks`` or ``checkouts`` events with metadata and ``proc_time``.

    ``via="kafka"`` reads the topic named like the kind from its earliest offset (a restarted query goes
    on from its checkpoint); ``options`` must name ``kafka.bootstrap.servers`` and should bound a batch
    with ``maxOffsetsPerTrigger``. ``via="files"`` replays Parquet files under ``path`` holding the event
    and metadata columns, ``maxFilesPerTrigger`` files per micro-batch.
    """
    if kind not in schemas.EVENTS:
        raise ValueError(f"unknown event kind {kind}")
    reader = spark.readStream if stream else spark.read
    options = dict(options or {})
    if via == "kafka":
        settings = {"subscribe": kind, "startingOffsets": "earliest", **options}
        return decode_topic(reader.format("kafka").options(**settings).load(), kind, decode)
    if via == "files":
        stored = T.StructType(schemas.EVENTS[kind].fields + schemas.METADATA.fields)
        files = reader.schema(stored).options(**options).parquet(path)
        return files.select(*stored.names, processing_time().alias("proc_time"))
    raise ValueError(f"unknown source {via}")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make each frame a temporary view, so SQL can name it."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
