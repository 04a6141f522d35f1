"""Dimension sources: a JDBC table or files, and the time-bounded copy that streams look up."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from clicktide import schemas
from clicktide.functions.eventtime import duration_seconds
from clicktide.operators.lookup import measured_bytes

# Inner bounds that cut lower-case UUID text into 16 ranges.
UUID_BOUNDS = list("123456789abcdef")


def uuid_ranges(column: str, bounds: list[str] = UUID_BOUNDS) -> list[str]:
    """SQL predicates that split a text column into ranges; every row, NULLs too, is in exactly one."""
    if not bounds:
        return ["1 = 1"]
    first = f"({column} < '{bounds[0]}' OR {column} IS NULL)"
    inner = [f"{column} >= '{low}' AND {column} < '{high}'" for low, high in zip(bounds, bounds[1:])]
    return [first, *inner, f"{column} >= '{bounds[-1]}'"]


def read_dimension(
    spark: SparkSession,
    name: str,
    via: str = "jdbc",
    options: dict[str, str] | None = None,
    path: str | None = None,
    bounds: list[str] = UUID_BOUNDS,
) -> DataFrame:
    """The ``products`` or ``users`` dimension, only the columns of its schema.

    ``via="jdbc"`` needs ``url`` (and ``driver``, ``user``, ``password``) in ``options`` and reads the
    id ranges between ``bounds`` in parallel; column pruning and constant filters reach the database.
    """
    schema = schemas.DIMENSIONS[name]
    options = dict(options or {})
    if via == "jdbc":
        url = options.pop("url")
        table = options.pop("dbtable", name)
        properties = {"fetchsize": "10000", **options}
        df = spark.read.jdbc(url, table, predicates=uuid_ranges(schema.names[0], bounds), properties=properties)
    elif via == "files":
        df = spark.read.options(**options).parquet(path)
    else:
        raise ValueError(f"unknown source {via}")
    return df.select(*schema.names)


class DimensionSnapshot:
    """Copies of a dimension, shared by all streams of a job; a new one is taken once the newest is older than ``ttl``.

    Rows looked up are at most ``ttl`` old; ``"0 seconds"`` copies anew on every call. A copy is a Parquet
    table in the shared folder, so lost executors re-read it instead of asking the database again, and its
    size is measured once. Streams call from threads of their own: one of them takes the copy, the others wait
    and get the same. A copy is switched to by name, as a whole; the folder of an older one is written again
    only when no micro-batch reads it any more, so there are at most as many folders as readers and two.
    """

    def __init__(
        self,
        spark: SparkSession,
        read: Callable[[], DataFrame],
        path: str,
        ttl: str = "10 minutes",
        clock: Callable[[], float] = time.monotonic,
    ):
        self._spark = spark
        self._read = read
        self._path = path
        self._ttl = duration_seconds(ttl)
        self._clock = clock
        self._lock = threading.Lock()
        self._readers: list[int] = []  # of every folder
        self._newest: int | None = None
        self._taken_at = 0.0
        self._copy: tuple[DataFrame, int] | None = None
        self.copies = 0

    def _take(self, now: float) -> None:
        free = [i for i, n in enumerate(self._readers) if n == 0 and i != self._newest]
        if not free:
            free = [len(self._readers)]
            self._readers.append(0)
        target = f"{self._path}/copy-{free[0]}"
        source = self._read()
        source.write.mode("overwrite").parquet(target)
        copy = self._spark.read.schema(source.schema).parquet(target)
        self._copy = copy, measured_bytes(copy)
        self._newest, self._taken_at = free[0], now
        self.copies += 1

    @contextmanager
    def reading(self) -> Iterator[tuple[DataFrame, int]]:
        """The newest copy and its measured size in bytes; its folder stays as it is until the block ends."""
        with self._lock:
            now = self._clock()
            if self._copy is None or now - self._taken_at >= self._ttl:
                self._take(now)
            folder, copy = self._newest, self._copy
            self._readers[folder] += 1
        try:
            yield copy
        finally:
            with self._lock:
                self._readers[folder] -= 1
