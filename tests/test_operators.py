"""Operators on hand-made rows."""

import re
from collections import Counter

import pytest
from fixtures import BASE, at, checkout, click, frame, rows, session_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clicktide import schemas
from clicktide.functions import duration_seconds, event_timestamp, with_event_time
from clicktide.operators import (
    activities,
    activity_counts,
    conform,
    interval_join,
    lookup_join,
    measured_bytes,
    prefix_columns,
    session_activity,
    tumbling_counts,
)
from clicktide.operators.skew import Side, hot_keys, salt_all, split_hot_groups
from clicktide.plans import checkout_clicks, enrich, product_clicks, user_sessions

SOME = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def products(spark, *more):
    return spark.createDataFrame(
        [("p1", "one", "first", "$1.00"), ("p2", "two", "second", "$2.00"), *more], schemas.PRODUCTS
    )


# ---- event time ----------------------------------------------------------------------------------


@pytest.mark.parametrize("seconds, whole", [(1.9, 1), (-1.9, -1), (0.0, 0), (1704067200.999999, 1704067200)])
def test_event_time_is_cut_toward_zero(spark, seconds, whole):
    row = spark.range(1).select(F.unix_seconds(event_timestamp(F.lit(seconds))).alias("s")).first()
    assert row["s"] == whole


@pytest.mark.parametrize("text, seconds", [("5 seconds", 5), ("1 hour", 3600), ("10 minutes", 600), ("2 days", 172800)])
def test_durations(text, seconds):
    assert duration_seconds(text) == seconds


# ---- columns -------------------------------------------------------------------------------------


def test_prefix_keeps_order(spark):
    df = prefix_columns(frame(spark, "clicks", [click("c", "u", 0)]), "click_")
    assert df.columns[:2] == ["click_click_id", "click_user_id"]
    assert df.columns[-1] == "click_proc_time"


def test_conform_maps_by_position_and_widens(spark):
    df = spark.range(1).select(
        F.lit("u").alias("a"), F.current_timestamp().alias("b"), F.current_timestamp().alias("c"),
        F.lit(1).alias("d"), F.lit("x").alias("e"), F.lit(2).alias("f"), F.lit("y").alias("g"),
    )
    out = conform(df, schemas.SESSION_ACTIVITIES)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.SESSION_ACTIVITIES]


def test_conform_rejects_what_an_insert_would_lose(spark):
    with pytest.raises(ValueError, match="columns for a sink"):
        conform(spark.range(1), schemas.PRODUCTS_CLICKS)
    four = spark.range(1).select(F.lit("p"), F.lit("t"), F.lit("t"), F.lit(1))
    with pytest.raises(ValueError, match="sink column window_start"):
        conform(four, schemas.PRODUCTS_CLICKS)


@pytest.mark.parametrize("sink, count", [
    ("enriched_clicks", 15), ("enriched_checkouts", 18), ("checkouts_clicks", 7),
    ("products_clicks_5min", 4), ("session_activities", 7),
])
def test_sink_widths(sink, count):
    assert len(schemas.SINKS[sink][1].fields) == count


# ---- lookup join ---------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lookup_drops_misses_and_keeps_duplicates(spark, limit):
    events = frame(spark, "clicks", [
        click("hit", "u", 0, "p1"), click("twice", "u", 1, "p2"), click("miss", "u", 2, "p9"), click("none", "u", 3, None),
    ])
    joined = lookup_join(events, products(spark, ("p2", "two again", "2b", "$2.50")), broadcast_limit=limit)
    assert joined.columns == events.columns + ["product_name", "product_description", "product_price"]
    assert rows(joined.select("click_id", "product_name", "product_price")) == Counter(
        [("hit", "one", "$1.00"), ("twice", "two", "$2.00"), ("twice", "two again", "$2.50")]
    )


def test_enriched_columns_follow_the_sink(spark):
    out = enrich.build(frame(spark, "checkouts", [checkout("k", "u", 0)]), products(spark), schemas.ENRICHED_CHECKOUTS)
    assert out.columns == schemas.ENRICHED_CHECKOUTS.names
    assert out.first()["description"] == "first"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_a_dimension_within_the_limit_is_broadcast(spark):
    events = frame(spark, "clicks", [click("c", "u", 0)])
    size = measured_bytes(products(spark))
    assert 0 < size < 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(lookup_join(events, products(spark), broadcast_limit=size + 100))
        assert "BroadcastHashJoin" not in _plan(lookup_join(events, products(spark), broadcast_limit=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _many_products(spark):
    return spark.range(200_000).select(
        F.col("id").cast("string").alias("product_id"), F.lit("a product's name").alias("product_name"),
        F.lit("brand type").alias("description"), F.lit("$1.00").alias("price"))


def test_a_dimension_goes_through_the_driver_up_to_a_few_megabytes(spark):
    """Each micro-batch broadcasts it anew, so what all of them send adds up."""
    events = frame(spark, "clicks", [click("c", "u", 0, "7"), click("none", "u", 0, "x")])
    assert 16 << 20 < measured_bytes(_many_products(spark)) < 32 << 20
    joined = lookup_join(events, _many_products(spark))
    assert "Broadcast" not in _plan(joined)
    assert rows(joined.select("click_id", "product_name")) == Counter([("c", "a product's name")])


def test_hot_product_is_dealt_over_cells_without_changing_the_join(spark):
    events = frame(spark, "clicks", [click(f"c{i}", "u", i, f"p{1 + (i % 3 == 0)}", i) for i in range(300)])
    dimension = products(spark, *[("p2", f"copy {i}", "", "") for i in range(40)])
    plain = rows(lookup_join(events, dimension).drop("proc_time"))
    split = lookup_join(events, dimension, broadcast_limit=0, hot_share=0.05, hot_min_rows=1)
    assert rows(split.drop("proc_time")) == plain
    assert sum(plain.values()) == 200 + 100 * 41


# ---- skew helpers --------------------------------------------------------------------------------


def test_hot_keys_finds_the_heavy_group_only(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    hot_hash = df.select(F.xxhash64(F.lit("hot"))).first()[0]
    side = Side(df, ["k"])
    found, empty = hot_keys([side, Side(df.limit(0), ["k"])], share=1 / 64, min_rows=100)
    assert list(found) == [hot_hash] and empty == {}
    assert found[hot_hash] >= 64 // 3
    assert hot_keys([side], share=1 / 64) == [{}]
    nulls = df.select(F.nullif("k", F.lit("hot")).alias("k"))
    assert hot_keys([Side(nulls, ["k"])], share=1 / 64, min_rows=100) == [{}]
    assert len(hot_keys([Side(nulls, ["k"], with_nulls=True)], share=1 / 64, min_rows=100)[0]) == 1


def test_dealt_hot_group_is_spread(spark):
    left = spark.range(1000).select(F.lit("hot").alias("lk"), F.col("id").alias("l"))
    right = spark.range(50).select(F.lit("hot").alias("rk"), F.col("id").alias("r"))
    dealt_left, dealt_right, same_cell = split_hot_groups(
        left, right, ["lk"], ["rk"], ["l"], ["r"], share=0.1, min_rows=10)
    per_cell = [r["count"] for r in dealt_left.groupBy("_left_i", "_left_j").count().collect()]
    assert len(per_cell) == 50 and max(per_cell) < 150
    pairs = dealt_left.join(dealt_right, (F.col("lk") == F.col("rk")) & same_cell)
    assert pairs.count() == 50_000
    assert pairs.select("l", "r").distinct().count() == 50_000


def test_hot_null_users_spread_in_a_left_join(spark):
    checkouts = with_event_time(
        frame(spark, "checkouts", [checkout(f"k{i}", None, 5, offset=i) for i in range(50)] + [checkout("k", "u", 5)]),
        "1 hour")
    clicks = with_event_time(frame(spark, "clicks", [click("c", "u", 0), click("n", None, 0)]), "1 hour")
    out = interval_join(checkouts, clicks, how="left")
    # Without a user they go around the joins: only rows with one are shuffled.
    assert len(re.findall("isnotnull\\(user_id", _plan(out))) >= 3
    assert rows(out.select("checkout_id", "click_id")) == Counter([(f"k{i}", None) for i in range(50)] + [("k", "c")])


def test_a_hot_click_cell_is_dealt_under_left(spark):
    clicks = with_event_time(
        frame(spark, "clicks", [click(f"c{i}", "u", i % 3, offset=i) for i in range(200)]), "1 hour")
    checkouts = with_event_time(frame(spark, "checkouts", [checkout("k", "u", 5), checkout("alone", "v", 5)]), "1 hour")
    out = interval_join(checkouts, clicks, how="left", hot_share=0.1, hot_min_rows=5)
    assert "_right_j" in _plan(out)
    assert rows(out.select("checkout_id", "click_id")) == Counter(
        [("k", f"c{i}") for i in range(200)] + [("alone", None)])


def test_salted_join_meets_every_pair_once(spark):
    left = spark.range(200).select((F.col("id") % 7).alias("lk"), F.col("id").alias("l"))
    right = spark.range(21).select((F.col("id") % 7).alias("rk"), F.col("id").alias("r"))
    salted_left, salted_right, same_cell = salt_all(left, right, ["l"], 5)
    joined = salted_left.join(salted_right, (F.col("lk") == F.col("rk")) & same_cell).select("l", "r")
    assert rows(joined) == rows(left.join(right, F.col("lk") == F.col("rk")).select("l", "r"))


# ---- interval join -------------------------------------------------------------------------------


def test_join_bounds_are_inclusive(spark):
    clicks = frame(spark, "clicks", [click(f"c{s}", "u", 7200 + s, "p2") for s in (-3601, -3600, 0, 1)])
    out = checkout_clicks.build(clicks, frame(spark, "checkouts", [checkout("k", "u", 7200)]))
    assert rows(out) == Counter([
        ("u", "k", BASE + 7200.0, "p1", "c-3600", BASE + 3600.0, "p2"),
        ("u", "k", BASE + 7200.0, "p1", "c0", BASE + 7200.0, "p2"),
    ])


def test_join_compares_whole_seconds_and_keeps_fractions(spark):
    out = checkout_clicks.build(
        frame(spark, "clicks", [click("c", "u", 10.75)]), frame(spark, "checkouts", [checkout("k", "u", 10.25)]))
    row = out.first()
    assert (row["checkout_time"], row["click_time"]) == (BASE + 10.25, BASE + 10.75)


def test_no_lookback_pairs_the_same_second(spark):
    clicks = frame(spark, "clicks", [click("c1", "u", 5.2), click("c2", "u", 4.9), click("c3", "u", 6)])
    checkouts = frame(spark, "checkouts", [checkout("k", "u", 5.8)])
    for how in ("inner", "left"):
        pairs = checkout_clicks.build(clicks, checkouts, "0 seconds", how=how).select("checkout_id", "click_id")
        assert rows(pairs) == Counter([("k", "c1")])


def test_left_join_keeps_unmatched_checkouts_once(spark):
    clicks = frame(spark, "clicks", [click("c", "u", 0), click("other", None, 0)])
    checkouts = frame(spark, "checkouts", [checkout("k1", "u", 5), checkout("k2", "v", 5), checkout("k3", None, 5)])
    left = checkout_clicks.build(clicks, checkouts, how="left").select("checkout_id", "click_id")
    assert rows(left) == Counter([("k1", "c"), ("k2", None), ("k3", None)])
    assert rows(checkout_clicks.build(clicks, checkouts).select("checkout_id", "click_id")) == Counter([("k1", "c")])
    with pytest.raises(ValueError):
        checkout_clicks.build(clicks, checkouts, how="full")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [False, True])
@SOME
@given(data=st.data())
def test_interval_join_equals_brute_force(spark, how, hot, data):
    event = st.tuples(st.sampled_from(["u", "u", "u", "v", "w"]), st.integers(0, 400))
    click_rows = data.draw(st.lists(event, min_size=1, max_size=60))
    checkout_rows = data.draw(st.lists(event, min_size=1, max_size=40))
    clicks = with_event_time(
        frame(spark, "clicks", [click(f"c{i}", u, s, offset=i) for i, (u, s) in enumerate(click_rows)]), "1 hour")
    checkouts = with_event_time(
        frame(spark, "checkouts", [checkout(f"k{i}", u, s, offset=i) for i, (u, s) in enumerate(checkout_rows)]), "1 hour")
    tuning = {"hot_share": 0.05, "hot_min_rows": 1} if hot else {}
    expected = Counter()
    for i, (u, t) in enumerate(checkout_rows):
        found = [j for j, (v, s) in enumerate(click_rows) if v == u and t - 60 <= s <= t]
        expected.update((f"k{i}", f"c{j}") for j in found)
        if how == "left" and not found:
            expected[(f"k{i}", None)] += 1
    out = interval_join(checkouts, clicks, "60 seconds", how, **tuning)
    assert rows(out.select("checkout_id", "click_id")) == expected


# ---- tumbling windows ----------------------------------------------------------------------------


def test_tumbling_edges_and_null_ids(spark):
    clicks = frame(spark, "clicks", [
        click("a", "u", 4.999), click("b", "u", 5.0), click(None, "u", 6), click("d", "u", 6, "p2"), click(None, "u", 20, "p2"),
    ])
    assert rows(product_clicks.build(clicks)) == Counter([
        ("p1", at(0), at(5), 1), ("p1", at(5), at(10), 1), ("p2", at(5), at(10), 1), ("p2", at(20), at(25), 0),
    ])


@SOME
@given(seconds=st.lists(st.integers(0, 1000), min_size=1, max_size=80))
def test_tumbling_counts_every_click_once(spark, seconds):
    clicks = with_event_time(frame(spark, "clicks", [click(f"c{i}", "u", s) for i, s in enumerate(seconds)]), "5 seconds")
    expected = Counter(s // 5 * 5 for s in seconds)
    found = {r["window_start"].timestamp(): r["num_clicks"] for r in tumbling_counts(clicks).collect()}
    assert sorted(found.values()) == sorted(expected.values())
    assert sum(found.values()) == len(seconds)


# ---- sessions ------------------------------------------------------------------------------------


def _sessions(spark, acts, **options):
    schema = "user_id string, activity_type string, activity_id string, s long"
    df = spark.createDataFrame(acts, schema).select(
        "user_id", "activity_type", "activity_id", F.timestamp_seconds(F.col("s") + BASE).alias("activity_ts"))
    return conform(session_activity(df, **options), schemas.SESSION_ACTIVITIES)


def test_session_ties_and_lists(spark):
    clicks = frame(spark, "clicks", [click("c1", "u", 0.9), click("c2", "u", 20.999), click("c3", "u", 31.0)])
    checkouts = frame(spark, "checkouts", [checkout("k1", "u", 10.2)])
    assert rows(user_sessions.build(clicks, checkouts)) == Counter([
        ("u", at(0), at(30), 1, "null,k1,null", 2, "c1,null,c2"),
        ("u", at(31), at(41), 0, "null", 1, "c3"),
    ])
    assert rows(user_sessions.build(clicks, checkouts, placeholder=None)) == Counter([
        ("u", at(0), at(30), 1, "k1", 2, "c1,c2"), ("u", at(31), at(41), 0, "", 1, "c3"),
    ])


def test_null_users_form_one_group_and_null_ids_leave_no_token(spark):
    acts = [(None, "click", "a", 0), (None, "checkout", "b", 3), ("u", "click", None, 0)]
    assert rows(_sessions(spark, acts)) == Counter([
        (None, at(0), at(13), 1, "null,b", 1, "a,null"), ("u", at(0), at(10), 0, "null", 1, None),
    ])


def test_session_bounds_can_be_filtered(spark):
    acts = [("u", "click", "a", 0), ("u", "click", "b", 8), ("u", "click", "c", 16)]
    for tuning in ({}, {"slice_gaps": 1}):
        sessions = _sessions(spark, acts, **tuning)
        assert sessions.where(F.col("session_start") > F.lit(at(5))).count() == 0
        assert sessions.where(F.col("session_end") == F.lit(at(26))).count() == 1


@pytest.mark.parametrize("slice_gaps", [1, 3, 64])
@SOME
@given(data=st.data())
def test_sliced_sessions_equal_brute_force(spark, slice_gaps, data):
    event = st.tuples(
        st.sampled_from(["u", "u", "u", "v", None]), st.sampled_from(["click", "checkout"]), st.integers(0, 300))
    acts = [(u, k, f"{k[1]}{i}", s) for i, (u, k, s) in enumerate(data.draw(st.lists(event, min_size=1, max_size=70)))]
    result = rows(_sessions(spark, acts, slice_gaps=slice_gaps))
    assert result == session_rows(acts, 10) == rows(_sessions(spark, acts))
    for row in result:
        assert len(row[4].split(",")) == len(row[6].split(",")) == row[3] + row[5]


def test_long_session_over_many_slices(spark):
    acts = [("u", "click", f"c{s:04d}", s) for s in range(0, 3000, 7)]
    sliced = _sessions(spark, acts, slice_gaps=2)
    assert "slice" in _plan(sliced)
    assert rows(sliced) == session_rows(acts, 10)


def test_union_and_counts(spark):
    clicks = with_event_time(frame(spark, "clicks", [click("c1", "u", 0), click("c1", "u", 0), click("c2", "v", 1)]), "1 hour")
    checkouts = with_event_time(frame(spark, "checkouts", [checkout("k1", "u", 2)]), "1 hour")
    acts = activities(clicks, checkouts)
    assert acts.columns == schemas.ACTIVITIES.names
    assert acts.count() == 4
    assert rows(activity_counts(acts)) == Counter([("u", 1, 2), ("v", 0, 1)])


def test_durations():
    from clicktide.functions.eventtime import duration_seconds

    assert [duration_seconds(d) for d in ("10 seconds", "1 HOUR", "1 hour 30 minutes", "2 weeks")] == [10, 3600, 5400, 1209600]
    for wrong in ("500 milliseconds", "hour", "", "1 hour 30"):
        with pytest.raises(ValueError):
            duration_seconds(wrong)

