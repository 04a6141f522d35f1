"""User activities and session windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.eventtime import duration_seconds, interval
from clicktide.functions.lists import joined_list, list_item

# Length of a batch time slice, in session gaps.
SLICE_GAPS = 64


def activities(clicks: DataFrame, checkouts: DataFrame) -> DataFrame:
    """Clicks and checkouts as one stream of (user_id, activity_type, activity_id, activity_ts)."""
    def shape(events: DataFrame, activity_type: str, event_id: str) -> DataFrame:
        return events.select(
            "user_id",
            F.lit(activity_type).alias("activity_type"),
            F.col(event_id).alias("activity_id"),
            F.col("event_ts").alias("activity_ts"),
        )

    return shape(clicks, "click", "click_id").unionByName(shape(checkouts, "checkout", "checkout_id"))


def _count_of(activity_type: str) -> Column:
    return F.sum(F.when(F.col("activity_type") == activity_type, 1).otherwise(0))


def activity_counts(acts: DataFrame) -> DataFrame:
    """Number of checkouts and clicks per user."""
    return acts.groupBy("user_id").agg(
        _count_of("checkout").alias("num_checkouts"), _count_of("click").alias("num_clicks")
    )


def _summary(gap: str, placeholder: str | None) -> list[Column]:
    return [
        (F.max("activity_ts") + interval(gap)).alias("session_end"),
        _count_of("checkout").alias("num_checkouts"),
        _count_of("click").alias("num_clicks"),
        F.collect_list(list_item(placeholder)).alias("items"),
    ]


def _stream_sessions(acts: DataFrame, gap: str, placeholder: str | None) -> DataFrame:
    """One row per user and session window of a stream.

    The bounds are aggregates and not the window's own start and end: Catalyst takes filters on those for
    filters on a grouping key and moves them below the merging of sessions, where they are wrong.
    """
    return (
        acts.groupBy(F.session_window("activity_ts", gap), "user_id")
        .agg(F.min("activity_ts").alias("session_start"), *_summary(gap, placeholder))
        .drop("session_window")
    )


def _batch_sessions(acts: DataFrame, gap: str, placeholder: str | None, keys: list[str]) -> DataFrame:
    """One row per keys and session: a session opens where the gap to the row before is too long.

    One shuffle and one sort by the keys serve the window and the grouping.
    """
    in_order = Window.partitionBy(*keys).orderBy("activity_ts")
    previous = F.lag("activity_ts").over(in_order)
    opens = previous.isNull() | (F.col("activity_ts") > previous + interval(gap))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        acts.where(F.col("activity_ts").isNotNull())
        .withColumn("opening", F.when(opens, F.col("activity_ts")))
        .withColumn("session_start", F.max("opening").over(so_far))
        .groupBy(*keys, "session_start")
        .agg(*_summary(gap, placeholder))
    )


def _report(sessions: DataFrame, placeholder: str | None) -> DataFrame:
    return sessions.select(
        "user_id",
        "session_start",
        "session_end",
        "num_checkouts",
        joined_list(F.col("items"), "checkout", placeholder).alias("list_checkouts"),
        "num_clicks",
        joined_list(F.col("items"), "click", placeholder).alias("list_clicks"),
    )


def session_activity(
    acts: DataFrame, gap: str = "10 seconds", placeholder: str | None = "null", slice_gaps: int = SLICE_GAPS,
) -> DataFrame:
    """Per user and session: bounds, counts and id lists of checkouts and clicks.

    A session ends ``gap`` after its last activity; activities exactly ``gap`` apart share a session.
    Building the plan reads nothing. Batch input is sessionized in time slices of every user, so a user's
    history spreads over tasks however long it is; see _sliced_sessions. A stream's micro-batch is bounded
    by its source's rate limit and holds open sessions only.
    """
    if acts.isStreaming:
        return _report(_stream_sessions(acts, gap, placeholder), placeholder)
    return _report(_sliced_sessions(acts, gap, placeholder, slice_gaps), placeholder)


def _sliced_sessions(acts: DataFrame, gap: str, placeholder: str | None, slice_gaps: int) -> DataFrame:
    """Sessions per (user, time slice), then joined up across slice borders.

    The rows are shuffled once, by user and slice. A piece further than one gap from both borders of its
    slice is a whole session. Only the pieces at a border go on: their bounds (two timestamps per piece, at
    most two pieces per user and slice, whatever the number of rows) are chained per user to find each one's
    session start, and the pieces are then gathered per session.
    """
    gap_seconds = duration_seconds(gap)
    width = max(1, gap_seconds) * slice_gaps
    sliced = acts.withColumn("slice", F.floor(F.unix_seconds("activity_ts") / width))
    # The branches below infer this filter or not; stated here, they read the same shuffle once.
    sliced = sliced.where(F.col("slice").isNotNull())
    pieces = _batch_sessions(sliced, gap, placeholder, ["user_id", "slice"])
    slice_start = F.timestamp_seconds(F.col("slice") * width)
    slice_end = F.timestamp_seconds((F.col("slice") + 1) * width)
    at_border = (F.col("session_start") < slice_start + interval(gap)) | (F.col("session_end") >= slice_end)
    columns = ["user_id", "session_start", "session_end", "num_checkouts", "num_clicks", "items"]
    whole = pieces.where(~at_border).select(columns)
    border = pieces.where(at_border).select(columns)

    in_order = Window.partitionBy("piece_user").orderBy("piece_start")
    previous_end = F.lag("piece_end").over(in_order)
    opens = previous_end.isNull() | (F.col("piece_start") > previous_end)
    chained = (
        border.select(
            F.col("user_id").alias("piece_user"),
            F.col("session_start").alias("piece_start"),
            F.col("session_end").alias("piece_end"),
            # Always equal in the join; with it the bounds come from the same shuffle as the pieces, not from
            # another one of fewer columns and another scan.
            F.size("items").alias("piece_size"),
        )
        .withColumn("opening", F.when(opens, F.col("piece_start")))
        .select("piece_user", "piece_start", "piece_size", F.max("opening").over(in_order).alias("first_start"))
    )
    # Users may be NULL; NULL users form a group like any other.
    gathered = (
        border.join(
            chained,
            F.col("user_id").eqNullSafe(F.col("piece_user")) & (F.col("session_start") == F.col("piece_start"))
            & (F.size("items") == F.col("piece_size")),
        )
        .groupBy("user_id", "first_start")
        .agg(
            F.max("session_end").alias("session_end"),
            F.sum("num_checkouts").alias("num_checkouts"),
            F.sum("num_clicks").alias("num_clicks"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
        .withColumnRenamed("first_start", "session_start")
    )
    return whole.unionByName(gathered.select(columns))
