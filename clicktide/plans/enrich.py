"""Job 1: clicks and checkouts with their product, into two tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas
from clicktide.operators import conform, lookup_join
from clicktide.plans.config import JobConfig, config_from, job_session
from clicktide.sources import DimensionSnapshot
from clicktide.streaming import append_batches, await_all, ensure_batch_table

_TABLES = {"clicks": "enriched_clicks", "checkouts": "enriched_checkouts"}


def build(events: DataFrame, products: DataFrame, sink: T.StructType, products_bytes: int | None = None) -> DataFrame:
    """Enriched events under the sink's column names."""
    return conform(lookup_join(events, products, products_bytes), sink)


def dimension_copies(spark: SparkSession, config: JobConfig) -> DimensionSnapshot:
    """Copies of the products for all streams of a job."""
    return DimensionSnapshot(
        spark, lambda: config.products(spark), config.checkpoint("products-dimension"), config.dimension_ttl)


def start_kind(
    spark: SparkSession, config: JobConfig, kind: str, events: DataFrame | None = None,
    copies: DimensionSnapshot | None = None,
) -> StreamingQuery:
    """Start the enrichment of one event kind.

    Every micro-batch looks up a copy of the dimension no older than its allowed age and of measured
    size, so each batch chooses anew between broadcasting and shuffling. A batch that is run again
    replaces its own partition, so nothing is lost or doubled.
    """
    name = _TABLES[kind]
    database, sink = schemas.SINKS[name]
    table = config.table(database, name)
    ensure_batch_table(spark, table, sink, config.table_format, config.warehouse)
    if copies is None:
        copies = dimension_copies(spark, config)

    @contextmanager
    def enriched(batch: DataFrame) -> Iterator[DataFrame]:
        with copies.reading() as (products, size):
            yield build(batch, products, sink, size)

    events = config.events(spark, kind) if events is None else events
    return append_batches(
        events, enriched, table, config.checkpoint(name), config.commit_interval, name, config.merge_every,
        config.merge_fanout)


def start(
    spark: SparkSession, config: JobConfig, events: dict[str, DataFrame] | None = None,
) -> list[StreamingQuery]:
    """Start both enrichments over one set of dimension copies; their sources differ, so nothing is read twice."""
    copies = dimension_copies(spark, config)
    return [start_kind(spark, config, kind, (events or {}).get(kind), copies) for kind in _TABLES]


if __name__ == "__main__":
    session = job_session("enrich")
    await_all(start(session, config_from(session)))
