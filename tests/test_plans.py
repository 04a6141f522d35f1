"""The plans Spark makes of the operators."""

import re

import pytest
from pyspark.sql import functions as F

from compare import TABLES_DIR

import __spark_entry__ as contract
from clicktide.operators import session_activity
from clicktide.sources.tables import checkouts_of, clicks_of, events_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def query(spark, name):
    return contract.queries()[name](spark, TABLES_DIR)


def test_scans_are_pruned_and_filtered(spark):
    text = plan(query(spark, "tumbling_clicks_5s"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {column.split(":")[0] for column in schema.split(",")} == {"event_id", "ts", "event_type", "props"}
    assert "EqualTo(event_type,click)" in text


def test_tumbling_counts_are_combined_before_their_only_shuffle(spark):
    text = plan(query(spark, "tumbling_clicks_5s"))
    assert text.index("functions=[count(") < text.index("Exchange") < text.index("partial_count(")
    assert len(exchanges(query(spark, "tumbling_clicks_5s"))) == 1


def test_interval_join_shuffles_each_side_once_by_user_and_bin(spark, no_broadcast):
    found = exchanges(query(spark, "interval_join_1h"))
    assert len(found) == 2
    assert all("user_id" in keys and "_bin" in keys for keys in found)


def test_streaming_interval_join_is_keyed_by_user_and_bin_and_keeps_narrow_rows(spark, capsys):
    clicks, checkouts = (f(events_table(spark, TABLES_DIR, stream=True)) for f in (clicks_of, checkouts_of))
    contract.checkout_clicks.build(clicks, checkouts).explain("formatted")
    text = capsys.readouterr().out
    rows = re.findall(r"(?:Left|Right) output \[\d+\]: \[(.*)\]", text)
    assert [[re.sub("#.*", "", c) for c in row.split(", ")] for row in rows] == [
        [f"{kind}_{c}" for c in ("user_id", f"{kind}_id", "product_id", "event_time", "event_ts", "bin")]
        for kind in ("checkout", "click")
    ]
    assert re.search(r"Arguments: \[checkout_user_id#\d+, checkout_bin#\d+L\], \[click_user_id#\d+, click_bin#\d+L\]", text)


def test_sessions_read_nothing_while_built_and_each_input_once(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sessions", "while building")
    result = contract._sessions("6 hours")(spark, TABLES_DIR)
    assert tracker.getJobIdsForGroup("sessions") == []
    spark.sparkContext.setJobGroup("other", "")
    result.collect()
    final = plan(result).split("Initial Plan")[0]
    # Clicks and checkouts are two filters on one file: a scan each, and their shuffle is read again for the borders.
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final


def test_sessions_shuffle_the_rows_by_user_and_slice(spark):
    found = exchanges(query(spark, "session_10s"))
    assert all("slice" in keys for keys in found if "piece_user" not in keys and "first_start" not in keys and "_start" not in keys)
    assert any("user_id" in keys and "slice" in keys for keys in found)


def test_a_small_users_history_is_spread_over_tasks(spark):
    """A user with 1 of 4000 rows in each slice still has tasks of its own for its slices."""
    acts = spark.range(40_000).select(
        F.when(F.col("id") % 4000 == 0, "small").otherwise(F.concat(F.lit("u"), F.col("id") % 977)).alias("user_id"),
        F.lit("click").alias("activity_type"), F.col("id").cast("string").alias("activity_id"),
        F.timestamp_seconds(F.col("id") * 100).alias("activity_ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sessions = session_activity(acts, "10 seconds").where("user_id = 'small'")
        found = sessions.select(F.spark_partition_id().alias("p"), "session_start").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 10 and len({r.p for r in found}) > 2


def test_no_python_in_any_plan(spark):
    for name in ("enrich_clicks", "interval_join_24h", "tumbling_clicks_1h", "session_10s", "activity_counts"):
        assert "Python" not in plan(query(spark, name))
