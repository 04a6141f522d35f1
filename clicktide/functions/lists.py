"""Ordered string lists of a group's activities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _token(activity_type: str, placeholder: str | None) -> Column:
    chosen = F.when(F.col("activity_type") == activity_type, F.col("activity_id"))
    return chosen if placeholder is None else chosen.otherwise(F.lit(placeholder))


def list_item(placeholder: str | None) -> Column:
    """What one activity adds to its group's lists, in a struct that sorts by (time, type, id).

    An activity leaves its id in the list of its own type and ``placeholder`` in the other's, so both
    lists have one token per activity; with ``placeholder=None`` it leaves nothing there.
    """
    return F.struct(
        "activity_ts",
        "activity_type",
        _token("checkout", placeholder).alias("checkout"),
        _token("click", placeholder).alias("click"),
    )


def joined_list(items: Column, activity_type: str, placeholder: str | None) -> Column:
    """The comma-joined tokens of one type, in order. NULL ids leave no token.

    A list with no token at all is NULL, or the empty string when there is no placeholder. Only
    built-in functions without lambdas, which stay in generated code.
    """
    tokens = F.sort_array(items).getField(activity_type)
    joined = F.array_join(tokens, ",")
    return joined if placeholder is None else F.when(F.array_max(tokens).isNotNull(), joined)
