"""The one declaration of every entity and sink schema."""

from __future__ import annotations

import json

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """``"name type, ..."`` as a struct; unlike fromDDL it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CLICKS = _struct(
    "click_id string, user_id string, product_id string, product_url string, "
    "user_agent string, ip string, event_time double"
)
CHECKOUTS = _struct(
    "checkout_id string, user_id string, product_id string, payment_method string, "
    "total_amount string, shipping_address string, billing_address string, "
    "user_agent string, ip_address string, event_time double"
)
EVENTS = {"clicks": CLICKS, "checkouts": CHECKOUTS}

# Broker metadata and processing time that every event carries besides its own fields.
METADATA = _struct("enqueued_at timestamp, partition_id bigint, offset bigint, topic_id string")
PROC_TIME = _struct("proc_time timestamp")

PRODUCTS = _struct("product_id string, product_name string, description string, price string")
# The users table also holds a password column; it is never read.
USERS = _struct("user_id string, username string")
DIMENSIONS = {"products": PRODUCTS, "users": USERS}

# Layout of the ``events`` tables that stand in for the topics in checks and benchmarks.
EVENTS_TABLE = _struct(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

ACTIVITIES = _struct("user_id string, activity_type string, activity_id string, activity_ts timestamp")

_PRODUCT_COLUMNS = _struct("product_name string, description string, price string")

ENRICHED_CLICKS = T.StructType(
    CLICKS.fields + METADATA.fields + PROC_TIME.fields + _PRODUCT_COLUMNS.fields
)
ENRICHED_CHECKOUTS = T.StructType(
    CHECKOUTS.fields + METADATA.fields + PROC_TIME.fields + _PRODUCT_COLUMNS.fields
)
CHECKOUTS_CLICKS = _struct(
    "user_id string, checkout_id string, checkout_time double, checkout_product_id string, "
    "click_id string, click_time double, click_product_id string"
)
PRODUCTS_CLICKS = _struct(
    "product_id string, window_start timestamp_ntz, window_end timestamp_ntz, num_clicks bigint"
)
SESSION_ACTIVITIES = _struct(
    "user_id string, session_start timestamp_ntz, session_end timestamp_ntz, "
    "num_checkouts bigint, list_checkouts string, num_clicks bigint, list_clicks string"
)

# Sink table -> (database, schema), columns in sink order.
SINKS = {
    "enriched_clicks": ("enriched_tables", ENRICHED_CLICKS),
    "enriched_checkouts": ("enriched_tables", ENRICHED_CHECKOUTS),
    "checkouts_clicks": ("stream_join_db", CHECKOUTS_CLICKS),
    "products_clicks_5min": ("window_agg_db", PRODUCTS_CLICKS),
    "session_activities": ("session_activities", SESSION_ACTIVITIES),
}

# Avro record names on the wire.
_AVRO_RECORDS = {"clicks": "Click", "checkouts": "Checkout"}


def avro_schema(kind: str) -> str:
    """The wire schema of an event kind as Avro JSON; every field is required."""
    fields = [{"name": f.name, "type": f.dataType.simpleString()} for f in EVENTS[kind].fields]
    return json.dumps({"type": "record", "name": _AVRO_RECORDS[kind], "fields": fields})
