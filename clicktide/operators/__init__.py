from clicktide.operators.columns import conform, prefix_columns
from clicktide.operators.interval import interval_join
from clicktide.operators.lookup import lookup_join, measured_bytes
from clicktide.operators.sessions import activities, activity_counts, session_activity
from clicktide.operators.windows import tumbling_counts

__all__ = [
    "activities",
    "activity_counts",
    "conform",
    "interval_join",
    "lookup_join",
    "measured_bytes",
    "prefix_columns",
    "session_activity",
    "tumbling_counts",
]
