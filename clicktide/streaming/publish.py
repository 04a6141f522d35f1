"""Publishing of events to a topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas

Encoder = Callable[[Column, str], Column]


def encode_framed_avro(schema_id: int) -> Encoder:
    """Encoder to Avro framed with the id the registry gave the schema. Needs the spark-avro package."""
    def encode(event: Column, kind: str) -> Column:
        from pyspark.sql.avro.functions import to_avro

        frame = F.lit(bytes([0]) + schema_id.to_bytes(4, "big"))
        return F.concat(frame, to_avro(event, schemas.avro_schema(kind)))

    return encode


def topic_records(df: DataFrame, kind: str, encode: Encoder) -> DataFrame:
    """Events -> (key, value) records keyed by user id; the value carries every field."""
    event = F.struct(*schemas.EVENTS[kind].names)
    return df.select(F.col("user_id").cast("binary").alias("key"), encode(event, kind).alias("value"))


def publish_events(
    df: DataFrame, kind: str, options: dict[str, str], encode: Encoder, checkpoint: str | None = None
) -> StreamingQuery | None:
    """Write events to the topic named like their kind; a stream needs ``checkpoint`` and gives its query."""
    records = topic_records(df, kind, encode)
    settings = {"topic": kind, **options}
    if df.isStreaming:
        return records.writeStream.format("kafka").options(**settings).option("checkpointLocation", checkpoint).start()
    records.write.format("kafka").options(**settings).save()
    return None
