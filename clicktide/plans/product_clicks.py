"""Job 3: clicks per product and tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas
from clicktide.functions import with_event_time
from clicktide.operators import conform, tumbling_counts
from clicktide.plans.config import JobConfig, config_from, job_session
from clicktide.streaming import await_all

TABLE = "products_clicks_5min"


def build(clicks: DataFrame, duration: str = "5 seconds", delay: str = "5 seconds") -> DataFrame:
    """Click counts under the sink's column names. The table's name says minutes, its windows are seconds."""
    return conform(tumbling_counts(with_event_time(clicks, delay), duration), schemas.PRODUCTS_CLICKS)


def start(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    return config.append(build(config.events(spark, "clicks"), config.window, config.window_delay), TABLE)


if __name__ == "__main__":
    session = job_session("product_clicks")
    await_all([start(session, config_from(session))])
