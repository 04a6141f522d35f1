"""Column renaming and sink conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Casts an insert may do by itself: widening, and dropping the zone of a UTC timestamp.
_IMPLICIT_CASTS = {
    (T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType),
    (T.TimestampType, T.TimestampNTZType),
    (T.NullType, T.StringType),
}


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Rename every column to ``prefix + name``."""
    return df.select([F.col(f"`{name}`").alias(prefix + name) for name in df.columns])


def conform(df: DataFrame, sink: T.StructType) -> DataFrame:
    """Give ``df`` the sink's names and types by position, as an INSERT does.

    Raises ValueError when the column counts differ or a type would need a lossy cast.
    """
    if len(df.columns) != len(sink.fields):
        raise ValueError(f"{len(df.columns)} columns for a sink of {len(sink.fields)}: {df.columns}")
    out = []
    for have, want in zip(df.schema.fields, sink.fields):
        column = F.col(f"`{have.name}`")
        if have.dataType != want.dataType:
            if (type(have.dataType), type(want.dataType)) not in _IMPLICIT_CASTS:
                raise ValueError(
                    f"column {have.name} is {have.dataType.simpleString()}, "
                    f"sink column {want.name} is {want.dataType.simpleString()}"
                )
            column = column.cast(want.dataType)
        out.append(column.alias(want.name))
    return df.select(out)
