
from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktide import schemas
from clicktide.functions import with_event_time
from clicktide.operators import activities, activity_counts, conform, interval_join, lookup_join, prefix_columns
from clicktide.plans import checkout_clicks, enrich, product_clicks, user_sessions
from clicktide.plans.config import JobConfig
from clicktide.session import configure, new_work_dir
from clicktide.sources import Replay, register_views
from clicktide.sources.tables import checkouts_of, clicks_of, events_table, products_of, users_of
from clicktide.streaming import LateRows, append_stream, append_table, await_all, merge_batches

try:  # The training-data operators come as a package of their own, which may be left out.
    import corpus_pipeline
    from clicktide.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# ---- inputs --------------------------------------------------------------------------------------


def _clicks(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return clicks_of(events_table(configure(spark), sf_dir, stream))


def _checkouts(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return checkouts_of(events_table(configure(spark), sf_dir, stream))


def _activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activities(
        with_event_time(_clicks(spark, sf_dir), "1 hour"), with_event_time(_checkouts(spark, sf_dir), "1 hour")
    )


def _comparable(df: DataFrame) -> DataFrame:
    """Without processing time, which differs between runs; timestamps as zone-free UTC."""
    return df.select([
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields if not f.name.endswith("proc_time")
    ])


def _run_config(spark: SparkSession) -> JobConfig:
    """Settings of a run in databases and folders of its own, which works off its input and stops."""
    folder = new_work_dir(spark, "query")
    return JobConfig(
        source="files",
        event_options={"maxFilesPerTrigger": "1"},
        dimension="files",
        dimension_path=f"{folder}/products",
        dimension_ttl="0 seconds",
        checkpoint_root=f"{folder}/checkpoints",
        commit_interval=None,
        database_prefix=f"run_{uuid.uuid4().hex[:12]}_",
        warehouse=f"{folder}/warehouse",
        state_partitions=spark.sparkContext.defaultParallelism,
    )


# ---- sources and projections ---------------------------------------------------------------------


def clicks_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(with_event_time(_clicks(spark, sf_dir), "1 hour"))


def checkouts_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(with_event_time(_checkouts(spark, sf_dir), "1 hour"))


def products_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_of(configure(spark), sf_dir)


def users_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_of(configure(spark), sf_dir)


def prefixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_columns(_comparable(_clicks(spark, sf_dir)), "click_")


# ---- lookup join ---------------------------------------------------------------------------------


def enrich_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(enrich.build(_clicks(spark, sf_dir), products_of(spark, sf_dir), schemas.ENRICHED_CLICKS))


def enrich_checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(enrich.build(_checkouts(spark, sf_dir), products_of(spark, sf_dir), schemas.ENRICHED_CHECKOUTS))


def enrich_clicks_partial_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue without the PROMO parts: clicks on them find no product."""
    products = products_of(configure(spark), sf_dir).where(~F.col("description").endswith(" PROMO"))
    return _comparable(enrich.build(_clicks(spark, sf_dir), products, schemas.ENRICHED_CLICKS))


def enrich_clicks_dup_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product listed twice, as after two dimension loads."""
    products = products_of(configure(spark), sf_dir)
    return _comparable(enrich.build(_clicks(spark, sf_dir), products.union(products), schemas.ENRICHED_CLICKS))


def enrich_clicks_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a dimension too large to broadcast."""
    joined = lookup_join(_clicks(spark, sf_dir), products_of(spark, sf_dir), broadcast_limit=0)
    return _comparable(conform(joined, schemas.ENRICHED_CLICKS))


def enrich_clicks_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as SQL text over views; Catalyst weighs the dimension's size."""
    register_views({"shop_clicks": _clicks(spark, sf_dir), "shop_products": products_of(spark, sf_dir)})
    joined = spark.sql("""
        SELECT c.*, p.product_name, p.description AS product_description, p.price AS product_price
        FROM shop_clicks c JOIN shop_products p ON c.product_id = p.product_id""")
    return _comparable(conform(joined, schemas.ENRICHED_CLICKS))


# ---- interval join -------------------------------------------------------------------------------


def _interval(lookback: str, how: str = "inner") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checkout_clicks.build(_clicks(spark, sf_dir), _checkouts(spark, sf_dir), lookback, how=how)

    return query


# ---- windows and sessions ------------------------------------------------------------------------


def _tumbling(duration: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return product_clicks.build(_clicks(spark, sf_dir), duration)

    return query


def activities_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_activities(spark, sf_dir))


def activity_counts_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_counts(_activities(spark, sf_dir))


def _sessions(gap: str, placeholder: str | None = "null") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return user_sessions.build(_clicks(spark, sf_dir), _checkouts(spark, sf_dir), gap, placeholder=placeholder)

    return query


# ---- streams into tables -------------------------------------------------------------------------


def _drain(spark: SparkSession, rows: DataFrame, sink: str) -> DataFrame:
    """Run a stream over all its input into its sink table and read the table back."""
    config = _run_config(spark)
    database, schema = schemas.SINKS[sink]
    table = config.table(database, sink)
    append_stream(
        rows, table, schema, config.checkpoint(sink), config.commit_interval, warehouse=config.warehouse,
        state_partitions=config.state_partitions,
    ).awaitTermination()
    return spark.sql(f"SELECT * FROM {table}")


def stream_tumbling_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain(spark, product_clicks.build(_clicks(spark, sf_dir, stream=True)), "products_clicks_5min")


def stream_session_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = user_sessions.build(_clicks(spark, sf_dir, True), _checkouts(spark, sf_dir, True), "6 hours")
    return _drain(spark, sessions, "session_activities")


def stream_interval_join_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = checkout_clicks.build(_clicks(spark, sf_dir, True), _checkouts(spark, sf_dir, True))
    return _drain(spark, pairs, "checkouts_clicks")


def _roundtrip_enriched(kind: str) -> Query:
    """Streaming enrichment into its table, read back with SQL."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = clicks_of if kind == "clicks" else checkouts_of
        config = _run_config(configure(spark))
        config.products = lambda session: products_of(session, sf_dir)
        stream = events(events_table(spark, sf_dir, stream=True))
        enrich.start_kind(spark, config, kind, stream).awaitTermination()
        name = f"enriched_{kind}"
        return _comparable(spark.sql(f"SELECT * FROM {config.table(schemas.SINKS[name][0], name)}"))

    return query


def _roundtrip(sink: str, result: Query) -> Query:
    """A batch result appended to its table, read back with SQL."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = _run_config(configure(spark))
        database, schema = schemas.SINKS[sink]
        table = config.table(database, sink)
        append_table(result(spark, sf_dir), table, schema, warehouse=config.warehouse)
        return spark.sql(f"SELECT * FROM {table}")

    return query


def _shared_table(steps: str) -> Query:
    """Enriched clicks written to one table by several writers: b a batch append, s a stream of its own
    checkpoint, m a merge of the batches so far."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = _run_config(configure(spark))
        name = "enriched_clicks"
        database, schema = schemas.SINKS[name]
        table = config.table(database, name)
        config.products = lambda session: products_of(session, sf_dir)
        for number, step in enumerate(steps):
            if step == "b":
                rows = enrich.build(_clicks(spark, sf_dir), products_of(spark, sf_dir), schema)
                append_table(rows, table, schema, warehouse=config.warehouse)
            elif step == "s":
                run = replace(config, checkpoint_root=f"{config.checkpoint_root}/{number}")
                run.products = config.products
                enrich.start_kind(spark, run, "clicks", _clicks(spark, sf_dir, stream=True)).awaitTermination()
            else:
                merge_batches(spark, table)
        return _comparable(spark.sql(f"SELECT * FROM {table}"))

    return query


# ---- jobs over files in event-time order ---------------------------------------------------------


def _replay(spark: SparkSession, sf_dir: str, config: JobConfig, kind: str, keep: Column | None = None, **layout) -> Replay:
    """The events of a kind (those to ``keep``) as files, and ``config`` reading them, a micro-batch per step."""
    events = _clicks(spark, sf_dir) if kind == "clicks" else _checkouts(spark, sf_dir)
    path = f"{new_work_dir(spark, 'replay')}/{kind}"
    replay = Replay(events if keep is None else events.where(keep), kind, path, **layout)
    config.event_paths[kind] = replay.path
    return replay


def _middle(spark: SparkSession, sf_dir: str) -> float:
    """Half way between the first and the last click's event time."""
    low, high = _clicks(spark, sf_dir).agg(F.min("event_time"), F.max("event_time")).first()
    return 0.0 if low is None else (low + high) / 2


def _run(spark: SparkSession, config: JobConfig, job: ModuleType) -> list[StreamingQuery]:
    """Work off what is published, go on from the job's checkpoints, and stop."""
    started = job.start(spark, config)
    started = started if isinstance(started, list) else [started]
    await_all(started)
    return started


def _sink_rows(spark: SparkSession, config: JobConfig, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {config.table(schemas.SINKS[name][0], name)}")


def _job(
    job: ModuleType, sink: str, kinds: tuple[str, ...] = ("clicks", "checkouts"), stops: bool = False, **settings: object,
) -> Query:
    """A job over the file reader, four micro-batches per input; with ``stops``, halted after two and started again."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = replace(_run_config(configure(spark)), **settings)
        replays = [_replay(spark, sf_dir, config, kind) for kind in kinds]
        for steps in (2, None) if stops else (None,):
            for replay in replays:
                replay.publish(steps)
            _run(spark, config, job)
        return _comparable(_sink_rows(spark, config, sink))

    return query


def _source_replay(kind: str) -> Query:
    """Events read back through the file reader in four micro-batches, metadata columns included."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = _run_config(configure(spark))
        _replay(spark, sf_dir, config, kind).publish()
        rows = config.events(spark, kind).drop("proc_time")
        table = config.table("replayed", kind)
        append_stream(
            rows, table, rows.schema, config.checkpoint(kind), config.commit_interval, warehouse=config.warehouse,
        ).awaitTermination()
        return _comparable(spark.sql(f"SELECT * FROM {table}"))

    return query


def stream_idle_session_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkouts end half way through the clicks: later sessions stay back, however far the clicks go."""
    config = replace(_run_config(configure(spark)), gap="6 hours")
    _replay(spark, sf_dir, config, "clicks").publish()
    _replay(spark, sf_dir, config, "checkouts", F.col("event_time") < _middle(spark, sf_dir)).publish()
    _run(spark, config, user_sessions)
    return _sink_rows(spark, config, "session_activities")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th click arrives behind all others: how many groups of window and product the watermark drops."""
    config = _run_config(configure(spark))
    replay = _replay(spark, sf_dir, config, "clicks", late=F.col("offset") % 50 == 0)
    watch = LateRows.watching(spark)
    try:
        replay.publish()
        before = _run(spark, config, product_clicks)
        replay.publish_late()
        dropped = sum(watch.total(query) for query in before + _run(spark, config, product_clicks))
    finally:
        spark.streams.removeListener(watch)
    return spark.createDataFrame([(dropped,)], "late_rows bigint")


def _with_products(spark: SparkSession, config: JobConfig, products: DataFrame) -> None:
    """Put a version of the dimension where the jobs' file reader finds it."""
    products.write.mode("overwrite").parquet(config.dimension_path)


def dimension_refresh_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the clicks meets a catalogue without the PROMO parts, the second half the whole one."""
    config = _run_config(configure(spark))
    replay = _replay(spark, sf_dir, config, "clicks", steps=2, borders=[_middle(spark, sf_dir)])
    products = products_of(spark, sf_dir)
    copies = enrich.dimension_copies(spark, config)
    for version in (products.where(~F.col("description").endswith(" PROMO")), products):
        _with_products(spark, config, version)
        replay.publish(1)
        enrich.start_kind(spark, config, "clicks", copies=copies).awaitTermination()
    return _comparable(_sink_rows(spark, config, "enriched_clicks"))


def job_enrich_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both enrichments as one job under one supervisor and over one set of dimension copies."""
    config = _run_config(configure(spark))
    for kind in ("clicks", "checkouts"):
        _replay(spark, sf_dir, config, kind).publish()
    _with_products(spark, config, products_of(spark, sf_dir))
    _run(spark, config, enrich)
    names = ["user_id", "product_id", "event_time", "topic_id", "product_name", "description", "price"]
    clicks = _sink_rows(spark, config, "enriched_clicks").select(F.col("click_id").alias("event_id"), *names)
    checkouts = _sink_rows(spark, config, "enriched_checkouts").select(F.col("checkout_id").alias("event_id"), *names)
    return clicks.unionByName(checkouts)


def sink_tiered_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two backfills and a stream that merges its table after every commit, over several levels."""
    config = replace(_run_config(configure(spark)), merge_every=1, merge_fanout=2)
    _with_products(spark, config, products_of(spark, sf_dir))
    database, schema = schemas.SINKS["enriched_clicks"]
    table = config.table(database, "enriched_clicks")
    for _ in range(2):
        rows = enrich.build(_clicks(spark, sf_dir), products_of(spark, sf_dir), schema)
        append_table(rows, table, schema, warehouse=config.warehouse)
    _replay(spark, sf_dir, config, "clicks", steps=6).publish()
    enrich.start_kind(spark, config, "clicks").awaitTermination()
    return _comparable(spark.sql(f"SELECT * FROM {table}"))


def sink_self_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose own rows are appended to it again."""
    config = _run_config(configure(spark))
    database, schema = schemas.SINKS["products_clicks_5min"]
    table = config.table(database, "products_clicks_5min")
    append_table(_tumbling("1 hour")(spark, sf_dir), table, schema, warehouse=config.warehouse)
    append_table(spark.table(table), table, schema, warehouse=config.warehouse)
    return spark.sql(f"SELECT * FROM {table}")


# ---- contract ------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Sessions of user activity on the smallest tables."""
    return _sessions("6 hours")(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator; each takes (spark, sf_dir)."""
    llm = {} if llm_queries is None else {**llm_queries.queries(), "pipeline": corpus_pipeline.run}
    return {
        **llm,
        "clicks_event_time": clicks_event_time,
        "checkouts_event_time": checkouts_event_time,
        "products_dimension": products_dimension,
        "users_dimension": users_dimension,
        "prefixed_columns": prefixed_columns,
        "enrich_clicks": enrich_clicks,
        "enrich_checkouts": enrich_checkouts,
        "enrich_clicks_partial_dim": enrich_clicks_partial_dim,
        "enrich_clicks_dup_dim": enrich_clicks_dup_dim,
        "enrich_clicks_shuffled": enrich_clicks_shuffled,
        "enrich_clicks_sql": enrich_clicks_sql,
        "interval_join_1h": _interval("1 hour"),
        "interval_join_24h": _interval("24 hours"),
        "interval_left_1h": _interval("1 hour", "left"),
        "interval_left_24h": _interval("24 hours", "left"),
        "tumbling_clicks_5s": _tumbling("5 seconds"),
        "tumbling_clicks_5min": _tumbling("5 minutes"),
        "tumbling_clicks_1h": _tumbling("1 hour"),
        "tumbling_clicks_1d": _tumbling("1 day"),
        "activities_union": activities_union,
        "activity_counts": activity_counts_per_user,
        "session_10s": _sessions("10 seconds"),
        "session_6h": _sessions("6 hours"),
        "session_6h_clean_lists": _sessions("6 hours", None),
        "session_24h": _sessions("24 hours"),
        "stream_tumbling_5s": stream_tumbling_5s,
        "stream_session_6h": stream_session_6h,
        "stream_interval_join_1h": stream_interval_join_1h,
        "sink_roundtrip_enriched_clicks": _roundtrip_enriched("clicks"),
        "sink_roundtrip_enriched_checkouts": _roundtrip_enriched("checkouts"),
        "sink_roundtrip_checkouts_clicks": _roundtrip("checkouts_clicks", _interval("24 hours")),
        "sink_roundtrip_products_clicks_5min": _roundtrip("products_clicks_5min", _tumbling("5 seconds")),
        "sink_roundtrip_session_activities": _roundtrip("session_activities", _sessions("6 hours")),
        "sink_backfill_then_stream": _shared_table("bs"),
        "sink_two_runs": _shared_table("ss"),
        "sink_merged": _shared_table("bsmsm"),
        "sink_tiered_merge": sink_tiered_merge,
        "sink_self_append": sink_self_append,
        "source_replay_clicks": _source_replay("clicks"),
        "source_replay_checkouts": _source_replay("checkouts"),
        "stream_replay_tumbling_5s": _job(product_clicks, "products_clicks_5min", ("clicks",)),
        "stream_replay_session_6h": _job(user_sessions, "session_activities", gap="6 hours"),
        "stream_replay_interval_1h": _job(checkout_clicks, "checkouts_clicks"),
        "stream_restart_session_6h": _job(user_sessions, "session_activities", stops=True, gap="6 hours"),
        "stream_restart_interval_1h": _job(checkout_clicks, "checkouts_clicks", stops=True),
        "stream_interval_salted_1h": _job(checkout_clicks, "checkouts_clicks", join_salts=4),
        "stream_idle_session_6h": stream_idle_session_6h,
        "stream_late_rows": stream_late_rows,
        "dimension_refresh_clicks": dimension_refresh_clicks,
        "job_enrich_both": job_enrich_both,
    }


_EVENT_VIEWS = """
clicks AS (
  SELECT cast(event_id AS varchar) AS click_id, cast(user_id AS varchar) AS user_id,
         json_extract_string(props, '$.k') AS product_id,
         'https://shop.example/p/' || json_extract_string(props, '$.k') AS product_url,
         'agent-' || user_id AS user_agent, 'ip-' || user_id AS ip, epoch(ts) AS event_time,
         ts AS enqueued_at, cast(0 AS bigint) AS partition_id, event_id AS "offset", 'clicks' AS topic_id,
         date_trunc('second', ts) AS event_ts
  FROM events WHERE event_type = 'click'),
checkouts AS (
  SELECT cast(event_id AS varchar) AS checkout_id, cast(user_id AS varchar) AS user_id,
         json_extract_string(props, '$.k') AS product_id,
         CASE WHEN value >= 50 THEN 'Online Banking' ELSE 'Cash' END AS payment_method,
         printf('$%.2f', value) AS total_amount,
         'street ' || user_id AS shipping_address, 'street ' || user_id AS billing_address,
         'agent-' || user_id AS user_agent, 'ip-' || user_id AS ip_address, epoch(ts) AS event_time,
         ts AS enqueued_at, cast(0 AS bigint) AS partition_id, event_id AS "offset", 'checkouts' AS topic_id,
         date_trunc('second', ts) AS event_ts
  FROM events WHERE event_type = 'purchase'),
products AS (
  SELECT cast(p_partkey AS varchar) AS product_id, p_name AS product_name,
         concat_ws(' ', p_brand, p_type) AS description, printf('$%.2f', p_retailprice) AS price
  FROM part),
activities AS (
  SELECT user_id, 'click' AS activity_type, click_id AS activity_id, event_ts AS activity_ts FROM clicks
  UNION ALL
  SELECT user_id, 'checkout', checkout_id, event_ts FROM checkouts)
"""


def _with(query: str) -> str:
    return f"WITH {_EVENT_VIEWS} {query}"


def _enrich_sql(kind: str, products: str = "products") -> str:
    return _with(
        f"SELECT e.* EXCLUDE (event_ts), p.product_name, p.description, p.price "
        f"FROM {kind} e JOIN {products} p ON e.product_id = p.product_id"
    )


def _interval_sql(lookback: str, join: str = "JOIN") -> str:
    return _with(f"""
        SELECT k.user_id, k.checkout_id, k.event_time AS checkout_time, k.product_id AS checkout_product_id,
               c.click_id, c.event_time AS click_time, c.product_id AS click_product_id
        FROM checkouts k {join} clicks c ON c.user_id = k.user_id
         AND c.event_ts BETWEEN k.event_ts - INTERVAL {lookback} AND k.event_ts""")


def _tumbling_sql(duration: str, having: str = "") -> str:
    return _with(f"""
        SELECT product_id, time_bucket(INTERVAL {duration}, event_ts) AS window_start,
               time_bucket(INTERVAL {duration}, event_ts) + INTERVAL {duration} AS window_end,
               count(click_id) AS num_clicks
        FROM clicks GROUP BY 1, 2, 3 {having}""")


def _session_sql(gap: str, clean: bool = False, having: str = "", source: str = "activities") -> str:
    def ids(kind: str) -> str:
        if clean:
            return (f"coalesce(string_agg(activity_id, ',' ORDER BY activity_ts, activity_type, activity_id) "
                    f"FILTER (WHERE activity_type = '{kind}'), '')")
        return (f"string_agg(CASE WHEN activity_type = '{kind}' THEN activity_id ELSE 'null' END, ',' "
                f"ORDER BY activity_ts, activity_type, activity_id)")

    return _with(f""",
        flagged AS (
          SELECT *, CASE WHEN activity_ts <= lag(activity_ts) OVER w + INTERVAL {gap} THEN 0 ELSE 1 END AS opens
          FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY activity_ts, activity_type, activity_id)),
        numbered AS (
          SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY activity_ts, activity_type, activity_id
                                     ROWS UNBOUNDED PRECEDING) AS session_no
          FROM flagged)
        SELECT user_id, min(activity_ts) AS session_start, max(activity_ts) + INTERVAL {gap} AS session_end,
               count(*) FILTER (WHERE activity_type = 'checkout') AS num_checkouts,
               {ids('checkout')} AS list_checkouts,
               count(*) FILTER (WHERE activity_type = 'click') AS num_clicks,
               {ids('click')} AS list_clicks
        FROM numbered GROUP BY user_id, session_no {having}""".lstrip())


def oracle_sql() -> dict[str, str]:
    """For each query, the SQL that DuckDB runs on the same tables."""
    prefixed = ", ".join(
        f'"{name}" AS "click_{name}"' for name in schemas.CLICKS.names + schemas.METADATA.names
    )
    pairs_1h, pairs_24h = _interval_sql("1 HOUR"), _interval_sql("24 HOURS")

    def enriched_by(writers: int) -> str:
        copies = " UNION ALL ".join(["SELECT * FROM clicks"] * writers)
        return _enrich_sql(f"({copies})")

    tumbling_5s, sessions_6h = _tumbling_sql("5 SECONDS"), _session_sql("6 HOURS")
    # A stream gives only what its final watermark has closed.
    closed_5s = _tumbling_sql(
        "5 SECONDS", "HAVING window_end <= (SELECT max(event_ts) - INTERVAL 5 SECONDS FROM clicks)")
    middle = "(SELECT (min(event_time) + max(event_time)) / 2 FROM clicks)"

    def closed_sessions(checkouts: str = "checkouts", source: str = "activities") -> str:
        return _session_sql("6 HOURS", source=source, having=f"""
            HAVING max(activity_ts) + INTERVAL 6 HOURS <= least(
              (SELECT max(event_ts) FROM clicks), (SELECT max(event_ts) FROM {checkouts})) - INTERVAL 1 HOUR""")

    early = f"(SELECT * FROM checkouts WHERE event_time < {middle})"
    early_activities = f"""(
        SELECT * FROM activities WHERE activity_type = 'click' UNION ALL
        SELECT user_id, 'checkout', checkout_id, event_ts FROM {early})"""
    tagged = ", ".join(["user_id", "product_id", "event_time", "topic_id", "product_name", "description", "price"])
    return {
        **({} if llm_queries is None else llm_queries.oracle_sql()),
        "clicks_event_time": _with("SELECT * FROM clicks"),
        "checkouts_event_time": _with("SELECT * FROM checkouts"),
        "products_dimension": _with("SELECT * FROM products"),
        "users_dimension": "SELECT cast(c_custkey AS varchar) AS user_id, c_name AS username FROM customer",
        "prefixed_columns": _with(f"SELECT {prefixed} FROM clicks"),
        "enrich_clicks": _enrich_sql("clicks"),
        "enrich_checkouts": _enrich_sql("checkouts"),
        "enrich_clicks_partial_dim": _enrich_sql(
            "clicks", "(SELECT * FROM products WHERE NOT ends_with(description, ' PROMO'))"),
        "enrich_clicks_dup_dim": _enrich_sql(
            "clicks", "(SELECT * FROM products UNION ALL SELECT * FROM products)"),
        "enrich_clicks_shuffled": _enrich_sql("clicks"),
        "enrich_clicks_sql": _enrich_sql("clicks"),
        "interval_join_1h": pairs_1h,
        "interval_join_24h": pairs_24h,
        "interval_left_1h": _interval_sql("1 HOUR", "LEFT JOIN"),
        "interval_left_24h": _interval_sql("24 HOURS", "LEFT JOIN"),
        "tumbling_clicks_5s": tumbling_5s,
        "tumbling_clicks_5min": _tumbling_sql("5 MINUTES"),
        "tumbling_clicks_1h": _tumbling_sql("1 HOUR"),
        "tumbling_clicks_1d": _tumbling_sql("1 DAY"),
        "activities_union": _with("SELECT * FROM activities"),
        "activity_counts": _with("""
            SELECT user_id, count(*) FILTER (WHERE activity_type = 'checkout') AS num_checkouts,
                   count(*) FILTER (WHERE activity_type = 'click') AS num_clicks
            FROM activities GROUP BY user_id"""),
        "session_10s": _session_sql("10 SECONDS"),
        "session_6h": sessions_6h,
        "session_6h_clean_lists": _session_sql("6 HOURS", clean=True),
        "session_24h": _session_sql("24 HOURS"),
        "stream_tumbling_5s": closed_5s,
        "stream_session_6h": closed_sessions(),
        "stream_interval_join_1h": pairs_1h,
        "sink_roundtrip_enriched_clicks": _enrich_sql("clicks"),
        "sink_roundtrip_enriched_checkouts": _enrich_sql("checkouts"),
        "sink_roundtrip_checkouts_clicks": pairs_24h,
        "sink_roundtrip_products_clicks_5min": tumbling_5s,
        "sink_roundtrip_session_activities": sessions_6h,
        "sink_backfill_then_stream": enriched_by(2),
        "sink_two_runs": enriched_by(2),
        "sink_merged": enriched_by(3),
        "sink_tiered_merge": enriched_by(3),
        "sink_self_append": f"SELECT t.* FROM ({_tumbling_sql('1 HOUR')}) t, range(2)",
        "source_replay_clicks": _with("SELECT * EXCLUDE (event_ts) FROM clicks"),
        "source_replay_checkouts": _with("SELECT * EXCLUDE (event_ts) FROM checkouts"),
        "stream_replay_tumbling_5s": closed_5s,
        "stream_replay_session_6h": closed_sessions(),
        "stream_replay_interval_1h": pairs_1h,
        "stream_restart_session_6h": closed_sessions(),
        "stream_restart_interval_1h": pairs_1h,
        "stream_interval_salted_1h": pairs_1h,
        "stream_idle_session_6h": closed_sessions(early, early_activities),
        "stream_late_rows": _with("""
            SELECT count(DISTINCT (product_id, time_bucket(INTERVAL 5 SECONDS, event_ts))) AS late_rows FROM clicks
            WHERE "offset" % 50 = 0 AND time_bucket(INTERVAL 5 SECONDS, event_ts) + INTERVAL 5 SECONDS <= (
              SELECT max(event_ts) - INTERVAL 5 SECONDS FROM clicks WHERE "offset" % 50 <> 0)"""),
        "dimension_refresh_clicks": _with(f"""
            SELECT e.* EXCLUDE (event_ts), p.product_name, p.description, p.price
            FROM clicks e JOIN products p ON e.product_id = p.product_id
            WHERE e.event_time >= {middle} OR NOT ends_with(p.description, ' PROMO')"""),
        "job_enrich_both": _with(f"""
            SELECT click_id AS event_id, {tagged} FROM clicks JOIN products USING (product_id) UNION ALL
            SELECT checkout_id, {tagged} FROM checkouts JOIN products USING (product_id)"""),
    }
