"""Job 4: sessions of user activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas
from clicktide.functions import with_event_time
from clicktide.operators import activities, conform, session_activity
from clicktide.plans.config import JobConfig, config_from, job_session
from clicktide.streaming import await_all

TABLE = "session_activities"


def build(
    clicks: DataFrame,
    checkouts: DataFrame,
    gap: str = "10 seconds",
    delay: str = "1 hour",
    placeholder: str | None = "null",
) -> DataFrame:
    """Sessions under the sink's column names."""
    acts = activities(with_event_time(clicks, delay), with_event_time(checkouts, delay))
    return conform(session_activity(acts, gap, placeholder), schemas.SESSION_ACTIVITIES)


def start(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    sessions = build(
        config.events(spark, "clicks"), config.events(spark, "checkouts"), config.gap, config.session_delay)
    return config.append(sessions, TABLE)


if __name__ == "__main__":
    session = job_session("user_sessions")
    await_all([start(session, config_from(session))])
