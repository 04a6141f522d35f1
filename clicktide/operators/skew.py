"""Splitting of hot join groups.

An equi-join sends all rows of a key to one task. When a key holds a large share of a side, its rows
are dealt over several cells and the other side's rows of that key are copied to each cell, so every
pair still meets exactly once:

* a left row gets one cell row number ``i`` and is copied over all ``j``;
* a right row gets one cell column number ``j`` and is copied over all ``i``.

Cold keys have a single cell. Which keys are hot is found with a mergeable frequent-items sketch, so
it costs one pass over the key columns and no shuffle of the rows; a wrong guess only changes the
split, never the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of its side on; so a side has at most 1 / HOT_SHARE hot keys. Smaller
# groups are of the order of an average shuffle partition.
HOT_SHARE = 1 / 2048
# Groups below this many rows fit one task whatever their share.
HOT_MIN_ROWS = 1_000_000
# Sketches are merged in this many tasks first, then in one.
_SKETCH_GROUPS = 256


@dataclass
class Side:
    """One input of an equi-join, or the only input of a grouping.

    Rows with a NULL key, which an inner join drops, count only when ``with_nulls``.
    """

    df: DataFrame
    keys: list[str]
    with_nulls: bool = False

    def hashes(self, label: int) -> DataFrame:
        counted = self.df if self.with_nulls else self.df.dropna(subset=self.keys)
        return counted.select(F.lit(label).alias("side"), F.xxhash64(*self.keys).alias("h"))


def hot_keys(sides: list[Side], share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS) -> list[dict[int, int]]:
    """For each side: hash of each hot key -> number of parts its rows are to be dealt into.

    One job for all sides. Gives at most ``1 / share`` entries per side, whatever the input's size.
    """
    top = ceil(1 / share)
    # The sketch misses no key above 3.5 / tracked of the rows.
    tracked = 4 * top
    hashes = reduce(DataFrame.unionByName, [side.hashes(i) for i, side in enumerate(sides)])
    summaries = (
        hashes.groupBy("side", (F.spark_partition_id() % _SKETCH_GROUPS).alias("g"))
        .agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count("*").alias("n"))
        .groupBy("side")
        .agg(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {top})").alias("items"),
            F.sum("n").alias("total"),
        )
        .collect()
    )
    found: list[dict[int, int]] = [{} for _ in sides]
    for summary in summaries:
        target = max(summary["total"] * share, min_rows)
        for entry in summary["items"]:
            if entry["count"] > target:
                found[summary["side"]][entry["item"]] = ceil(entry["count"] / target)
    return found


def split_hot_groups(
    left: DataFrame,
    right: DataFrame,
    left_keys: list[str],
    right_keys: list[str],
    left_row: list[str],
    right_row: list[str],
    keep_left: bool = False,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> tuple[DataFrame, DataFrame, Column | None]:
    """Deal the hot groups of an equi-join over cells.

    ``left_row`` / ``right_row`` are columns that tell rows of a group apart (an event's id and broker
    position). ``keep_left`` forbids copies of left rows, as a left outer join needs. Returns both
    sides and the condition to add to the join, None when nothing is hot.
    """
    sides = [Side(left, left_keys, with_nulls=keep_left)]
    if not keep_left:
        sides.append(Side(right, right_keys))
    left_parts, right_parts = (hot_keys(sides, share, min_rows) + [{}])[:2]
    if not left_parts and not right_parts:
        return left, right, None
    # At most 2 / share rows, so this table may be broadcast.
    cells = left.sparkSession.createDataFrame(
        [(h, left_parts.get(h, 1), right_parts.get(h, 1)) for h in {*left_parts, *right_parts}],
        "_h bigint, _rows int, _cols int",
    )

    def deal(side: DataFrame, keys: list[str], row: list[str], own: str, other: str, names: tuple[str, str]) -> DataFrame:
        return (
            side.withColumn("_key_hash", F.xxhash64(*keys))
            .join(F.broadcast(cells), F.col("_key_hash") == F.col("_h"), "left")
            .withColumn(names[0], F.pmod(F.xxhash64(*row), F.coalesce(own, F.lit(1))).cast("int"))
            .withColumn(names[1], F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
            .drop("_key_hash", "_h", "_rows", "_cols")
        )

    dealt_left = deal(left, left_keys, left_row, "_rows", "_cols", ("_left_i", "_left_j"))
    dealt_right = deal(right, right_keys, right_row, "_cols", "_rows", ("_right_j", "_right_i"))
    same_cell = (F.col("_left_i") == F.col("_right_i")) & (F.col("_left_j") == F.col("_right_j"))
    return dealt_left, dealt_right, same_cell


def salt_all(left: DataFrame, right: DataFrame, left_row: list[str], salts: int) -> tuple[DataFrame, DataFrame, Column]:
    """Deal every left group over ``salts`` cells and copy the right side to each.

    For streaming left sides, whose hot keys cannot be counted beforehand.
    """
    dealt_left = left.withColumn("_left_i", F.pmod(F.xxhash64(*left_row), F.lit(salts)).cast("int"))
    copied_right = right.withColumn("_right_i", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt_left, copied_right, F.col("_left_i") == F.col("_right_i")
