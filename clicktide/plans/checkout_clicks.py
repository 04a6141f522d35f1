"""Job 2: each checkout with the user's clicks of the preceding hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas
from clicktide.functions import with_event_time
from clicktide.operators import conform, interval_join
from clicktide.plans.config import JobConfig, config_from, job_session
from clicktide.streaming import await_all

TABLE = "checkouts_clicks"


def build(
    clicks: DataFrame, checkouts: DataFrame, lookback: str = "1 hour", delay: str = "1 hour", how: str = "inner",
    salts: int = 1,
) -> DataFrame:
    """Checkout-click pairs under the sink's column names."""
    pairs = interval_join(with_event_time(checkouts, delay), with_event_time(clicks, delay), lookback, how, salts=salts)
    return conform(pairs, schemas.CHECKOUTS_CLICKS)


def start(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    pairs = build(
        config.events(spark, "clicks"), config.events(spark, "checkouts"), config.lookback, config.join_delay,
        salts=config.join_salts)
    return config.append(pairs, TABLE)


if __name__ == "__main__":
    session = job_session("checkout_clicks")
    await_all([start(session, config_from(session))])
