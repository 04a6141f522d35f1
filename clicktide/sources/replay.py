"""Events laid out as files that a stream replays in the order of their event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide import schemas

# Relative error of the step borders: steps differ in size by about twice this share of all rows.
BORDER_ERROR = 0.001


class Replay:
    """Events of one kind, cut by event time into ``steps`` of like size and published step by step.

    A file stream takes files in the order in which they were written. Rows are dealt into steps by ``borders`` of
    event time (``steps - 1`` of them, by default sampled quantiles) and written once, one folder per step; ``publish``
    then copies whole steps to ``path``, each by a write of its own that begins when the one before has ended and gives
    ``files_per_step`` files. A stream that reads ``path`` with ``options`` therefore has one micro-batch per step
    and never meets a row older than those of earlier steps. Rows without an event time come first. Publish a
    step before a stream starts; stores that keep times in whole seconds need steps that take longer than one to write.

    ``late`` marks rows that are held back: they are published behind all steps, by ``publish_late``.
    """

    def __init__(
        self, events: DataFrame, kind: str, path: str, steps: int = 4, files_per_step: int = 1,
        borders: list[float] | None = None, late: Column | None = None,
    ):
        self.path, self.steps, self.files_per_step = path, steps, files_per_step
        self.published = 0
        self._schema = T.StructType(schemas.EVENTS[kind].fields + schemas.METADATA.fields)
        self._spark = events.sparkSession
        self._staged = f"{path}-steps"
        names = self._schema.names
        rows = events.select(*names, (F.lit(False) if late is None else F.coalesce(late, F.lit(False))).alias("_late"))
        if borders is None:
            borders = rows.stat.approxQuantile("event_time", [i / steps for i in range(1, steps)], BORDER_ERROR)
        step = F.lit(0)
        for border in borders:
            step = step + F.when(F.col("event_time") >= border, 1).otherwise(0)
        rows.select(*names, F.when(F.col("_late"), steps).otherwise(step).alias("step")).repartitionByRange(
            "step", "event_time", "offset").sortWithinPartitions("step", "event_time").write.partitionBy("step").parquet(
            self._staged)

    @property
    def options(self) -> dict[str, str]:
        """Options of the file source that give one micro-batch per step."""
        return {"maxFilesPerTrigger": str(self.files_per_step)}

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def _step(self, step: int) -> DataFrame:
        stored = T.StructType([*self._schema.fields, T.StructField("step", T.IntegerType())])
        rows = self._spark.read.schema(stored).parquet(self._staged).where(F.col("step") == step).drop("step")
        if self.files_per_step == 1:
            return rows.coalesce(1).sortWithinPartitions("event_time")
        return rows.repartitionByRange(self.files_per_step, "event_time").sortWithinPartitions("event_time")

    def publish(self, steps: int | None = None) -> None:
        """Add the next ``steps`` steps, by default all that are left."""
        last = self.steps if steps is None else min(self.steps, self.published + steps)
        while self.published < last:
            self._append(self._step(self.published))
            self.published += 1

    def publish_late(self) -> None:
        self._append(self._step(self.steps))
