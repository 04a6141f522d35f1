"""Interval join of checkouts with the same user's preceding clicks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions.eventtime import duration_seconds, interval
from clicktide.operators.columns import prefix_columns
from clicktide.operators.skew import HOT_MIN_ROWS, split_hot_groups

_POSITION = ("partition_id", "offset")


def _narrow(events: DataFrame, event_id: str, prefix: str) -> DataFrame:
    position = [name for name in _POSITION if name in events.columns]
    return prefix_columns(events.select("user_id", event_id, "product_id", "event_time", "event_ts", *position), prefix)


def _matches(lookback: str) -> Column:
    return (
        (F.col("checkout_user_id") == F.col("click_user_id"))
        & (F.col("checkout_bin") == F.col("click_bin"))
        & (F.col("click_event_ts") >= F.col("checkout_event_ts") - interval(lookback))
        & (F.col("click_event_ts") <= F.col("checkout_event_ts"))
    )


def _salted(rows: DataFrame, salts: int, side: str) -> DataFrame:
    """Every row in one of ``salts`` cells, by its own columns, so a row that is read again falls alike."""
    if salts == 1:
        return rows
    return rows.withColumn(f"{side}_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))


def _copied(rows: DataFrame, salts: int, side: str) -> DataFrame:
    if salts == 1:
        return rows
    return rows.withColumn(f"{side}_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def _same_salt(salts: int) -> Column:
    return F.lit(True) if salts == 1 else F.col("checkout_salt") == F.col("click_salt")


def interval_join(
    checkouts: DataFrame,
    clicks: DataFrame,
    lookback: str = "1 hour",
    how: str = "inner",
    hot_share: float | None = None,
    hot_min_rows: int = HOT_MIN_ROWS,
    salts: int = 1,
) -> DataFrame:
    """One row per checkout and click of the same user with the click in [checkout - lookback, checkout].

    Both ends are inclusive and compared on ``event_ts`` (whole seconds); the output keeps the exact
    event times. ``how="left"`` also gives one row with NULL click columns per unmatched checkout; on
    streams that row comes once the watermark has passed.

    Time is cut into bins of one lookback and the bin is part of the join key, so a user's rows spread
    over tasks and a checkout meets only clicks of two neighbouring bins. The inner join copies
    checkouts to both bins; a stream's left join must not copy checkouts and copies clicks instead.

    Nothing is read while the plan is built: a user's bin that is too large for one task is left to
    adaptive skew handling. With ``hot_share``, batch cells from this share on are counted beforehand and
    dealt over tasks. A stream cannot count beforehand: with ``salts`` every cell is dealt into so many, by the
    rows of the side that is not copied to both bins, and the other side is copied to each. The salt is part of
    the state's key, so it is fixed for a query's life, as the number of its state partitions is.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    if salts < 1:
        raise ValueError(f"salts must be 1 or more, not {salts}")
    width = max(1, duration_seconds(lookback))
    checkout_bin = F.floor(F.unix_seconds("checkout_event_ts") / width)
    click_bin = F.floor(F.unix_seconds("click_event_ts") / width)
    left = _narrow(checkouts, "checkout_id", "checkout_")
    # Clicks without a user or a time match nothing.
    right = _narrow(clicks, "click_id", "click_").dropna(subset=["click_user_id", "click_event_ts"])
    streaming = checkouts.isStreaming or clicks.isStreaming

    if streaming and how == "left":
        joined = _salted(left, salts, "checkout").withColumn("checkout_bin", checkout_bin).join(
            _copied(right, salts, "click").withColumn("click_bin", F.explode(F.array(click_bin, click_bin + 1))),
            _matches(lookback) & _same_salt(salts), "left")
        return _pairs(joined)

    keyed = left.dropna(subset=["checkout_user_id", "checkout_event_ts"])
    dealt_left = _copied(keyed, salts, "checkout").withColumn(
        "checkout_bin", F.explode(F.array(checkout_bin - 1, checkout_bin)))
    dealt_right = _salted(right, salts, "click").withColumn("click_bin", click_bin)
    matches = _matches(lookback) & _same_salt(salts)
    if hot_share is not None and not streaming:
        dealt_left, dealt_right, same_cell = split_hot_groups(
            dealt_left, dealt_right,
            ["checkout_user_id", "checkout_bin"], ["click_user_id", "click_bin"],
            left.columns, right.columns, share=hot_share, min_rows=hot_min_rows,
        )
        if same_cell is not None:
            matches = matches & same_cell
    pairs = _pairs(dealt_left.join(dealt_right, matches))
    if how == "inner":
        return pairs
    return pairs.unionByName(_pairs(_without_clicks(left, right, lookback, checkout_bin, click_bin)))


def _without_clicks(left: DataFrame, right: DataFrame, lookback: str, checkout_bin: Column, click_bin: Column) -> DataFrame:
    """Checkouts without a click, click columns NULL.

    They are looked for among the distinct seconds in which a user clicked: at most one row per second of a
    bin, whatever the number of clicks. Checkouts without a user or a time are not shuffled.
    """
    matchable = F.col("checkout_user_id").isNotNull() & F.col("checkout_event_ts").isNotNull()
    seconds = right.select("click_user_id", "click_event_ts").distinct().withColumn(
        "click_bin", F.explode(F.array(click_bin, click_bin + 1)))
    alone = left.where(matchable).withColumn("checkout_bin", checkout_bin).join(seconds, _matches(lookback), "left_anti")
    unmatched = alone.drop("checkout_bin").unionByName(left.where(~matchable))
    types = {f.name: f.dataType for f in right.schema.fields}
    return unmatched.select("*", *[F.lit(None).cast(types[name]).alias(name) for name in right.columns])


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("checkout_user_id").alias("user_id"),
        F.col("checkout_checkout_id").alias("checkout_id"),
        F.col("checkout_event_time").alias("checkout_time"),
        "checkout_product_id",
        F.col("click_click_id").alias("click_id"),
        F.col("click_event_time").alias("click_time"),
        "click_product_id",
    )
