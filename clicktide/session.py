"""Session settings, the shared scratch folder and the lake catalog."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job and query relies on.
RUNTIME_CONF = {
    # Event time is wall-clock time in the session zone, so the zone must be fixed.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows go to Python workers in batches of at most 8 MB, however long they are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
    # A silent input must hold results back, never be skipped.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # State lives off-heap and only its changes are uploaded per micro-batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Keep a stream join's four stores in one per partition.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Merge a user's sessions inside each map task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_CONF to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, catalog: dict[str, str] | None = None, **conf: str) -> SparkSession:
    """Build a session for a job; ``catalog`` is the result of lake_catalog_conf."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **(catalog or {}), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    A temporary folder stands in only for local masters, where all tasks see the same disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_scratch[app]


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder, never used before."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def lake_catalog_conf(
    name: str,
    uri: str,
    warehouse: str,
    ref: str = "main",
    s3_endpoint: str | None = None,
    region: str | None = None,
) -> dict[str, str]:
    """Spark settings for an Iceberg catalog over a Nessie ref in an S3-style store.

    Needs the Iceberg runtime package on the class path. Keys come from LAKE_S3_ACCESS_KEY and
    LAKE_S3_SECRET_KEY in the environment; without them the store's default credential chain applies.
    """
    prefix = f"spark.sql.catalog.{name}"
    conf = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.catalog-impl": "org.apache.iceberg.nessie.NessieCatalog",
        f"{prefix}.uri": uri,
        f"{prefix}.ref": ref,
        f"{prefix}.warehouse": warehouse,
        f"{prefix}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
        f"{prefix}.s3.path-style-access": "true",
        "spark.sql.defaultCatalog": name,
    }
    if s3_endpoint:
        conf[f"{prefix}.s3.endpoint"] = s3_endpoint
    if region:
        conf[f"{prefix}.client.region"] = region
    access_key, secret_key = os.environ.get("LAKE_S3_ACCESS_KEY"), os.environ.get("LAKE_S3_SECRET_KEY")
    if access_key and secret_key:
        conf[f"{prefix}.s3.access-key-id"] = access_key
        conf[f"{prefix}.s3.secret-access-key"] = secret_key
    return conf
