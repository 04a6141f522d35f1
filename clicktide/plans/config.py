"""Job settings, read from Spark properties ``spark.clicktide.*``; secrets from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas
from clicktide.session import build_session, lake_catalog_conf, shared_dir
from clicktide.sources import read_dimension, read_events
from clicktide.streaming import append_stream
from clicktide.streaming.sinks import FANOUT


@dataclass
class JobConfig:
    """Where a job reads and writes, and its durations."""

    source: str = "kafka"
    event_paths: dict[str, str] = field(default_factory=dict)
    event_options: dict[str, str] = field(default_factory=dict)
    dimension: str = "jdbc"
    dimension_path: str | None = None
    dimension_options: dict[str, str] = field(default_factory=dict)
    # Bounds of the id ranges that a JDBC dimension is read in; None: those of UUIDs.
    dimension_bounds: list[str] | None = None
    # Age up to which looked-up dimension rows may lag behind the database.
    dimension_ttl: str = "10 minutes"
    checkpoint_root: str = ""
    # None: work off what is there and stop.
    commit_interval: str | None = "10 seconds"
    table_format: str = "parquet"
    # Name prefix and folder of new databases; by default none, and the catalog's own warehouse.
    database_prefix: str = ""
    warehouse: str | None = None
    # Durations: windows and their delay, the join's lookback and delay, the sessions' gap and delay.
    window: str = "5 seconds"
    window_delay: str = "5 seconds"
    lookback: str = "1 hour"
    join_delay: str = "1 hour"
    gap: str = "10 seconds"
    session_delay: str = "1 hour"
    # Cells that a user's bin of the interval join is dealt over; fixed by a query's first start.
    join_salts: int = 1
    # Commits after which a query merges its table's batches; 0: never.
    merge_every: int = 0
    # Gathered partitions of a level that are merged again.
    merge_fanout: int = FANOUT
    # State partitions of queries that start for the first time; None: the session's shuffle partitions.
    state_partitions: int | None = None

    def events(self, spark: SparkSession, kind: str) -> DataFrame:
        return read_events(spark, kind, self.source, self.event_options, self.event_paths.get(kind))

    def products(self, spark: SparkSession) -> DataFrame:
        bounds = {} if self.dimension_bounds is None else {"bounds": self.dimension_bounds}
        return read_dimension(
            spark, "products", self.dimension, self.dimension_options, self.dimension_path, **bounds)

    def append(self, rows: DataFrame, name: str) -> StreamingQuery:
        """Start appending a stream to the sink ``name``."""
        database, sink = schemas.SINKS[name]
        return append_stream(
            rows, self.table(database, name), sink, self.checkpoint(name), self.commit_interval, self.table_format,
            self.warehouse, name, self.merge_every, self.merge_fanout, self.state_partitions)

    def table(self, database: str, name: str) -> str:
        return f"{self.database_prefix}{database}.{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_root}/{name}"


def job_session(app_name: str) -> SparkSession:
    """Session of a submitted job, with the lake catalog when CLICKTIDE_CATALOG_URI names one."""
    uri = os.environ.get("CLICKTIDE_CATALOG_URI")
    catalog = None
    if uri:
        catalog = lake_catalog_conf(
            os.environ.get("CLICKTIDE_CATALOG", "lake"),
            uri,
            os.environ["CLICKTIDE_WAREHOUSE"],
            ref=os.environ.get("CLICKTIDE_CATALOG_REF", "main"),
            s3_endpoint=os.environ.get("CLICKTIDE_S3_ENDPOINT"),
            region=os.environ.get("CLICKTIDE_S3_REGION"),
        )
    return build_session(app_name, catalog)


def config_from(spark: SparkSession) -> JobConfig:
    """Read ``spark.clicktide.*``; database user and password come from DIMENSION_USER and DIMENSION_PASSWORD."""
    def get(key: str, default: str | None = None) -> str | None:
        return spark.conf.get(f"spark.clicktide.{key}", default)

    config = JobConfig(
        source=get("source", "kafka"),
        event_paths={k: p for k in ("clicks", "checkouts") if (p := get(f"{k}.path"))},
        dimension=get("dimension", "jdbc"),
        dimension_path=get("products.path"),
        dimension_ttl=get("dimension.ttl", "10 minutes"),
        checkpoint_root=get("checkpointRoot") or f"{shared_dir(spark)}/clicktide",
        commit_interval=None if get("runOnce", "false").lower() == "true" else get("commitInterval", "10 seconds"),
        table_format=get("tableFormat", "parquet"),
        database_prefix=get("databasePrefix", ""),
        warehouse=get("warehouse"),
        window=get("window", "5 seconds"),
        window_delay=get("window.delay", "5 seconds"),
        lookback=get("lookback", "1 hour"),
        join_delay=get("join.delay", "1 hour"),
        gap=get("gap", "10 seconds"),
        session_delay=get("session.delay", "1 hour"),
        join_salts=int(get("join.salts", "1")),
        merge_every=int(get("mergeEvery", "0")),
        merge_fanout=int(get("mergeFanout", str(FANOUT))),
        state_partitions=int(n) if (n := get("statePartitions")) else None,
        dimension_bounds=[b for b in text.split(",") if b] if (text := get("jdbc.bounds")) is not None else None,
    )
    if config.source == "kafka":
        config.event_options = {
            "kafka.bootstrap.servers": get("kafka.bootstrapServers"),
            "maxOffsetsPerTrigger": get("kafka.maxOffsetsPerTrigger", "10000000"),
        }
    else:
        config.event_options = {"maxFilesPerTrigger": get("files.maxPerTrigger", "1000")}
    if config.dimension == "jdbc":
        config.dimension_options = {
            "url": get("jdbc.url"),
            "driver": get("jdbc.driver", "org.postgresql.Driver"),
            "user": os.environ["DIMENSION_USER"],
            "password": os.environ["DIMENSION_PASSWORD"],
        }
    return config
