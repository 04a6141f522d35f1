from clicktide.functions.eventtime import (
    duration_seconds,
    event_timestamp,
    interval,
    processing_time,
    with_event_time,
)
from clicktide.functions.lists import joined_list, list_item

__all__ = [
    "duration_seconds",
    "event_timestamp",
    "interval",
    "joined_list",
    "list_item",
    "processing_time",
    "with_event_time",
]
