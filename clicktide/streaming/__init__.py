from clicktide.streaming.publish import publish_events
from clicktide.streaming.sinks import (
    append_batches,
    append_stream,
    append_table,
    create_zones,
    ensure_batch_table,
    ensure_table,
    jdbc_append,
    merge_batches,
    overwrite_batch,
)
from clicktide.streaming.supervise import LateRows, await_all, rows_dropped_late

__all__ = [
    "LateRows",
    "append_batches",
    "append_stream",
    "append_table",
    "await_all",
    "create_zones",
    "ensure_batch_table",
    "ensure_table",
    "jdbc_append",
    "merge_batches",
    "overwrite_batch",
    "publish_events",
    "rows_dropped_late",
]
