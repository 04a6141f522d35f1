"""Lake tables and the ways to append to them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicktide.operators.columns import conform
from clicktide.session import shared_dir

# Names of the lake zones a new deployment starts with.
ZONES = ("landing", "staging", "curated")


def create_zones(spark: SparkSession) -> None:
    """Create the lake zone databases that do not exist yet."""
    for zone in ZONES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {zone}")


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _ensure_database(spark: SparkSession, table: str, warehouse: str | None) -> None:
    database = table.rpartition(".")[0]
    where = f"LOCATION '{warehouse}/{database}.db'" if warehouse else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {where}")


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType, using: str = "parquet", warehouse: str | None = None
) -> None:
    """Create ``db.table`` and its database (in folder ``warehouse``, if given) if missing."""
    _ensure_database(spark, table, warehouse)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) USING {using}")


# Gathered partitions of a level that are merged into one of the next.
FANOUT = 8
# Runs that one merge gathers at most: its view names each of them until the next merge.
MOST_RUNS = 64
# A merge that began longer ago is taken to have died.
STALE_MERGE_SECONDS = 6 * 3600

# Runs of rows that merge_batches has gathered, with their level; shown only once the view names them.
_MERGED = "merged_"
_APPEND = "append_"
_STREAM = "stream_"


def _publish_view(spark: SparkSession, table: str, names: list[str], closed: dict[str, int], merged: list[str]) -> None:
    """Show every batch of every run but those gathered elsewhere, and the runs they were gathered in.

    ``closed`` has, for a run, the last of its batches that ``merged`` runs hold.
    """
    columns = ", ".join(f"`{n}`" for n in names)
    plain = [f"NOT startswith(run, '{_MERGED}')"]
    plain += [f"NOT (run = '{run}' AND batch_id <= {last})" for run, last in sorted(closed.items())]
    shown = f"({' AND '.join(plain)})"
    if merged:
        shown += " OR run IN (" + ", ".join(f"'{run}'" for run in merged) + ")"
    record = json.dumps({"closed": closed, "merged": merged})
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('merged_runs' = '{record}') AS "
        f"SELECT {columns} FROM {table}_batches WHERE {shown}"
    )


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def ensure_batch_table(
    spark: SparkSession, table: str, schema: T.StructType, using: str = "parquet", warehouse: str | None = None
) -> None:
    """Create ``table`` as a view with exactly ``schema`` over ``table_batches``.

    ``table_batches`` has one partition per writer (``run``) and batch, so any number of backfills, streams and
    checkpoints add to one table and a batch that is run again replaces nothing but itself. A plain table of that
    name raises.
    """
    _ensure_database(spark, table, warehouse)
    if spark.catalog.tableExists(table) and not _is_view(spark, table):
        raise ValueError(f"{table} is a plain table, not a view over batches")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table}_batches ({_columns(schema)}, run string, batch_id bigint) "
        f"USING {using} PARTITIONED BY (run, batch_id)"
    )
    if not spark.catalog.tableExists(table):
        _publish_view(spark, table, schema.names, {}, [])


def _partitions(spark: SparkSession, batches: str) -> list[tuple[str, int]]:
    """(run, batch) of every committed partition."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {batches}").collect():
        run, batch_id = (part.partition("=")[2] for part in row["partition"].split("/"))
        found.append((run, int(batch_id)))
    return found


@contextmanager
def _only_merge(spark: SparkSession, table: str, stale_seconds: float) -> Iterator[bool]:
    """Whether this process alone merges ``table``: creating one table is what the catalog lets a single process do."""
    lock = f"{table}_merging"

    def taken() -> bool:
        try:
            spark.sql(f"CREATE TABLE {lock} (since double) USING parquet TBLPROPERTIES ('since' = '{time.time()}')")
        except AnalysisException:
            return False
        return True

    mine = taken()
    if not mine and spark.catalog.tableExists(lock):
        since = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {lock}").collect()}.get("since", "0")
        if time.time() - float(since) > stale_seconds:
            spark.sql(f"DROP TABLE IF EXISTS {lock}")
            mine = taken()
    try:
        yield mine
    finally:
        if mine:
            spark.sql(f"DROP TABLE IF EXISTS {lock}")


def _level(run: str) -> int:
    level, _, rest = run.removeprefix(_MERGED).partition("_")
    return int(level) if rest else 0


def merge_batches(
    spark: SparkSession, table: str, fanout: int = FANOUT, most_runs: int = MOST_RUNS,
    stale_seconds: float = STALE_MERGE_SECONDS,
) -> bool:
    """Rewrite the single batches of a batch table, all but each stream's newest, as one gathered partition.

    Gathered partitions have levels: with ``fanout`` of a level the same write merges these too, into one of the next
    level, and so on. So there are fewer than ``fanout`` partitions a level, each row is rewritten once a level, and the
    view names these partitions and at most ``most_runs`` runs, however many writers the table has had. Returns whether
    runs beyond ``most_runs`` are left for another call.

    To be run now and then, beside running writers: a stream only ever writes its newest batch, and a batch append
    commits its only one. A second process that merges meanwhile does nothing. What was gathered is recorded run by run,
    so a new run is never taken for an old one. Replacing the view is the one step that counts: a merge that fails before
    it changed nothing readers see, and the next one first drops what it left. Partitions replaced by a merge stay until
    the next, for readers that have planned with them; their runs are named no longer then.
    """
    with _only_merge(spark, table, stale_seconds) as mine:
        return mine and _merge(spark, table, fanout, most_runs)


def _merge(spark: SparkSession, table: str, fanout: int, most_runs: int) -> bool:
    batches = f"{table}_batches"
    properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    record = json.loads(properties["merged_runs"])
    closed, merged = record["closed"], record["merged"]
    present: dict[str, list[int]] = {}
    for run, batch_id in _partitions(spark, batches):
        if (run.startswith(_MERGED) and run not in merged) or batch_id <= closed.get(run, -1):
            spark.sql(f"ALTER TABLE {batches} DROP IF EXISTS PARTITION (run = '{run}', batch_id = {batch_id})")
        elif not run.startswith(_MERGED):
            present.setdefault(run, []).append(batch_id)
    last, n_batches = {}, {}
    for run, ids in present.items():
        done = sorted(ids) if run.startswith(_APPEND) else sorted(ids)[:-1]
        if done:
            last[run], n_batches[run] = done[-1], len(done)
    if not last:
        return False
    chosen = sorted(last, key=lambda run: (-n_batches[run], run))[:most_runs]
    level, absorbed = 0, []
    while len(same := [run for run in merged if _level(run) == level]) + 1 >= fanout:
        absorbed += same
        level += 1
    names = spark.table(table).columns
    ready = reduce(or_, [(F.col("run") == run) & (F.col("batch_id") <= last[run]) for run in chosen])
    if absorbed:
        ready = ready | F.col("run").isin(absorbed)
    target = f"{_MERGED}{level}_{uuid.uuid4().hex}"
    # Rebalanced to files of advisory size.
    overwrite_batch(spark.table(batches).where(ready).select(*names).hint("rebalance"), table, 0, target, into=True)
    # What the former merges closed has been dropped above, so only the runs of this one need be named.
    kept = [run for run in merged if run not in absorbed]
    _publish_view(spark, table, names, {run: last[run] for run in chosen}, [*kept, target])
    return len(last) > len(chosen)


def overwrite_batch(df: DataFrame, table: str, batch_id: int, run: str, into: bool = False) -> None:
    """Write one batch of a run into its own partition; a batch run again replaces its first try.

    ``into`` appends instead, to a partition that is new: only so may ``df`` read the table itself.
    """
    view = f"batch_{batch_id}_of_{table.replace('.', '_')}_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    spark = df.sparkSession
    try:
        names = ", ".join(f"`{n}`" for n in df.columns)
        spark.sql(
            f"INSERT {'INTO' if into else 'OVERWRITE'} TABLE {table}_batches "
            f"PARTITION (run = '{run}', batch_id = {batch_id}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def stream_run(spark: SparkSession, checkpoint: str) -> str:
    """The run of a stream: its query id, which its checkpoint keeps over restarts."""
    return _STREAM + spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def append_table(
    df: DataFrame, table: str, schema: T.StructType, using: str = "parquet", warehouse: str | None = None
) -> None:
    """Append a batch result by position, creating the table if missing; other writers may add to it too."""
    spark = df.sparkSession
    if using != "parquet":
        ensure_table(spark, table, schema, using, warehouse)
        conform(df, schema).write.insertInto(table)
        return
    ensure_batch_table(spark, table, schema, using, warehouse)
    # The run is new, so nothing is replaced and the rows may come from the table itself.
    overwrite_batch(conform(df, schema), table, 0, f"{_APPEND}{uuid.uuid4().hex}", into=True)


def append_batches(
    df: DataFrame, transform: Callable[[DataFrame], AbstractContextManager[DataFrame]], table: str, checkpoint: str,
    interval: str | None = "10 seconds", name: str | None = None, merge_every: int = 0, fanout: int = FANOUT,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start writing each micro-batch of a stream, transformed, into its own partition of a batch table.

    What ``transform`` opens for a batch is closed once the batch is written. After every ``merge_every`` batches the
    query merges the table's batches itself. ``state_partitions`` stands for the session's number of shuffle
    partitions in a query's first start, which fixes the number of its state partitions.
    """
    run: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not run:
            run.append(stream_run(spark, checkpoint))
        # Off in sessions of stateful queries, whose own plan is made by now; rebalancing the result needs it.
        with _setting(spark, "spark.sql.adaptive.enabled", "true"):
            with transform(batch) as rows:
                overwrite_batch(rows, table, batch_id, run[0])
            if merge_every and (batch_id + 1) % merge_every == 0:
                merge_batches(spark, table, fanout)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return _start(writer.foreachBatch(write).start, df.sparkSession, state_partitions)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """A session setting while the block runs; None leaves it."""
    before = spark.conf.get(key)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _start(writer: Callable[[], StreamingQuery], spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a query with so many state partitions; it copies the session's settings as it starts."""
    with _setting(spark, "spark.sql.shuffle.partitions", str(state_partitions) if state_partitions else None):
        return writer()


def append_stream(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    checkpoint: str,
    interval: str | None = "10 seconds",
    using: str = "parquet",
    warehouse: str | None = None,
    name: str | None = None,
    merge_every: int = 0,
    fanout: int = FANOUT,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table, exactly once, one commit per trigger.

    ``interval=None`` works off what is there and stops. Backfills, other streams and new checkpoints may add to the
    same table. A commit's rows are rebalanced, so it writes files of advisory size however many tasks the last
    stage has. Formats with commits of their own (Iceberg) are written by their streaming sink.
    """
    spark = df.sparkSession
    rows = conform(df, schema)
    if using == "parquet":
        ensure_batch_table(spark, table, schema, using, warehouse)
        return append_batches(
            rows, lambda batch: nullcontext(batch.hint("rebalance")), table, checkpoint, interval, name, merge_every, fanout,
            state_partitions)
    ensure_table(spark, table, schema, using, warehouse)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return _start(lambda: writer.trigger(**trigger).toTable(table), spark, state_partitions)


def _write_jdbc(rows: DataFrame, table: str, options: dict[str, str], batch_size: int) -> None:
    properties = dict(options)
    url = properties.pop("url")
    rows.write.option("batchsize", str(batch_size)).jdbc(url, table, mode="append", properties=properties)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table of the shared folder, written once per name.

    A later call with the name gives the same rows and does not evaluate ``df``. The rows count as written
    once their number has been put beside them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{name}"
    try:
        done = spark.read.schema("n bigint").parquet(f"{path}.done").count()
    except AnalysisException:
        done = 0
    if not done:
        df.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(df.schema).parquet(path)
        rows.agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}.done")
    return spark.read.schema(df.schema).parquet(path)


def jdbc_append(
    df: DataFrame, table: str, options: dict[str, str], batch_size: int = 1000, stage: str | None = None,
    write: Callable[[DataFrame, str, dict[str, str], int], None] = _write_jdbc,
) -> DataFrame:
    """Append a dimension to a JDBC table, created if missing; returns the first column, its ids.

    The rows are staged first, so the ids returned are those of the rows written, also when ``df`` would give others
    if it were read again. A load that fails raises; with the same ``stage`` name it can be run again and writes the
    same rows. Spark commits per partition, so a partition whose task is lost between its commit and its
    report is inserted again; the dimension has no key, and lookups keep duplicates.
    """
    rows = staged(df, stage or uuid.uuid4().hex)
    write(rows, table, options, batch_size)
    return rows.select(rows.columns[0])
