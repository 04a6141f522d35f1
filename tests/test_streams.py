"""Jobs as streams: replay in several micro-batches, late data, idle inputs, restarts."""

import uuid
from collections import Counter
from dataclasses import replace

import pytest
from compare import TABLES_DIR
from fixtures import at, checkout, click, rows, stored_schema
from pyspark.sql import functions as F

import __spark_entry__ as contract
from clicktide import schemas
from clicktide.operators import lookup_join
from clicktide.plans import checkout_clicks, enrich, product_clicks, user_sessions
from clicktide.plans.config import JobConfig
from clicktide.sources import read_events
from clicktide.streaming import (
    append_stream,
    append_table,
    await_all,
    LateRows,
    create_zones,
    ensure_batch_table,
    ensure_table,
    jdbc_append,
    merge_batches,
    overwrite_batch,
    rows_dropped_late,
)
from clicktide.streaming import sinks
from clicktide.streaming.sinks import ZONES, _partitions

HOUR = 3600


class Replay:
    """Event folders, dimension and sink tables of one test, run batch by batch."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder
        self.config = JobConfig(
            source="files",
            event_paths={kind: f"{folder}/{kind}" for kind in schemas.EVENTS},
            event_options={"maxFilesPerTrigger": "1"},
            dimension="files",
            dimension_path=f"{folder}/products",
            dimension_ttl="0 seconds",
            checkpoint_root=f"{folder}/checkpoints",
            commit_interval=None,
            database_prefix=f"t_{uuid.uuid4().hex[:8]}_",
            warehouse=f"{folder}/warehouse",
        )
        for kind in schemas.EVENTS:
            self.add(kind)

    def add(self, kind, *events):
        """One file of events, one micro-batch."""
        df = self.spark.createDataFrame(list(events), stored_schema(kind))
        df.coalesce(1).write.mode("append").parquet(self.config.event_paths[kind])

    def products(self, *items):
        self.spark.createDataFrame(list(items), schemas.PRODUCTS).coalesce(1).write.mode("overwrite").parquet(
            self.config.dimension_path)

    def drain(self, job):
        queries = job.start(self.spark, self.config)
        queries = queries if isinstance(queries, list) else [queries]
        await_all(queries)
        return queries

    def table(self, sink):
        return self.spark.table(self.config.table(schemas.SINKS[sink][0], sink))


@pytest.fixture
def replay(spark, work_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield Replay(spark, work_dir)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_tumbling_stream_equals_batch_on_closed_windows(replay):
    for first in (0, 30, 60):
        replay.add("clicks", *[click(f"c{s}", "u", s, f"p{s % 2}") for s in range(first, first + 30)])
    replay.drain(product_clicks)
    batch = product_clicks.build(read_events(replay.spark, "clicks", "files", path=f"{replay.folder}/clicks", stream=False))
    closed = Counter({r: n for r, n in rows(batch).items() if r[2] <= at(89 - 5)})
    assert rows(replay.table("products_clicks_5min")) == closed
    assert closed


def test_late_clicks_are_dropped_and_counted(replay):
    replay.add("clicks", click("a", "u", 0))
    replay.add("clicks", click("b", "u", 20_000))
    # Rows are late against the watermark of the batch before, so a batch lies between.
    replay.add("clicks", click("b2", "u", 20_001))
    replay.add("clicks", click("late1", "u", 1))
    replay.add("clicks", click("c", "u", 40_000))
    replay.add("clicks", click("c2", "u", 40_001))
    replay.add("clicks", click("late2", "u", 20_002))
    query, = replay.drain(product_clicks)
    assert rows_dropped_late(query) == 2
    assert rows(replay.table("products_clicks_5min")) == Counter([
        ("p1", at(0), at(5), 1), ("p1", at(20_000), at(20_005), 2)])


def test_late_clicks_are_counted_over_more_batches_than_are_reported(replay, spark):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    late = LateRows.watching(spark)
    try:
        for s in (20_000, 20_001, 1, 2, 3, 20_002, 20_003):
            replay.add("clicks", click(f"c{s}", "u", s))
        query, = replay.drain(product_clicks)
        assert rows_dropped_late(query) < 3
        assert late.total(query) == 3
    finally:
        spark.streams.removeListener(late)
        spark.conf.set(key, before)


def test_sessions_wait_for_the_slower_input(replay):
    replay.add("clicks", click("c1", "u", 0))
    replay.add("clicks", click("c2", "v", 20_000))
    replay.add("checkouts", checkout("k1", "u", 5))
    replay.drain(user_sessions)
    assert replay.table("session_activities").count() == 0
    # Inputs start without a watermark after a restart, so both must go on.
    replay.add("clicks", click("c3", "v", 20_000))
    replay.add("checkouts", checkout("k2", "v", 20_000))
    replay.drain(user_sessions)
    assert rows(replay.table("session_activities")) == Counter([("u", at(0), at(15), 1, "null,k1", 1, "c1,null")])


def test_session_grows_over_micro_batches(replay):
    for i, second in enumerate((0, 10, 20, 31)):
        replay.add("clicks", click(f"c{i}", "u", second))
    replay.add("clicks", click("end", "z", 9 * HOUR))
    replay.add("checkouts", checkout("k", "u", 5))
    replay.add("checkouts", checkout("end", "z", 9 * HOUR))
    replay.drain(user_sessions)
    assert rows(replay.table("session_activities")) == Counter([
        ("u", at(0), at(30), 1, "null,k,null,null", 3, "c0,null,c1,c2"),
        ("u", at(31), at(41), 0, "null", 1, "c3"),
    ])


def test_interval_stream_pairs_once_and_clears_state(replay):
    replay.add("clicks", *[click(f"c{s}", "u", 2 * HOUR + s, offset=s) for s in (-3601, -3600, 0, 1)])
    replay.add("checkouts", checkout("k", "u", 2 * HOUR))
    replay.add("clicks", click("x", "z", 9 * HOUR))
    replay.add("checkouts", checkout("x", "z", 9 * HOUR))
    query, = replay.drain(checkout_clicks)
    pairs = rows(replay.table("checkouts_clicks").select("checkout_id", "click_id"))
    assert pairs == Counter([("k", "c-3600"), ("k", "c0"), ("x", "x")])
    # Only the last click and the last checkout (in its two bins) are still held.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3


def test_left_interval_stream_emits_unmatched_after_the_watermark(replay, spark):
    replay.add("clicks", click("c", "u", 0))
    replay.add("checkouts", checkout("k1", "u", 5), checkout("k2", "v", 5))
    for s in (9, 18):
        replay.add("clicks", click(f"x{s}", "z", s * HOUR))
        replay.add("checkouts", checkout(f"x{s}", "z", s * HOUR))
    pairs = checkout_clicks.build(
        replay.config.events(spark, "clicks"), replay.config.events(spark, "checkouts"), how="left")
    query = (
        pairs.writeStream.format("memory").queryName("left_pairs").trigger(availableNow=True)
        .option("checkpointLocation", f"{replay.folder}/left").start()
    )
    query.awaitTermination()
    found = rows(spark.table("left_pairs").select("checkout_id", "click_id"))
    assert found == Counter([("k1", "c"), ("k2", None), ("x9", "x9"), ("x18", "x18")])


def test_restart_loses_and_doubles_nothing(replay):
    replay.products(("p1", "one", "d", "$1"))
    replay.add("clicks", click("c1", "u", 0))
    replay.add("checkouts", checkout("k1", "u", 10))
    for job in (checkout_clicks, enrich):
        replay.drain(job)
    replay.add("clicks", click("c2", "u", 20))
    replay.add("checkouts", checkout("k2", "u", 30))
    for job in (checkout_clicks, enrich):
        replay.drain(job)
    assert rows(replay.table("checkouts_clicks").select("checkout_id", "click_id")) == Counter(
        [("k1", "c1"), ("k2", "c1"), ("k2", "c2")])
    assert rows(replay.table("enriched_clicks").select("click_id")) == Counter([("c1",), ("c2",)])
    assert rows(replay.table("enriched_checkouts").select("checkout_id")) == Counter([("k1",), ("k2",)])


def test_enrichment_sees_new_products_and_keeps_old_rows(replay):
    replay.products(("p1", "one", "d", "$1"))
    replay.add("clicks", click("c1", "u", 0, "p1"), click("c2", "u", 0, "p2"))
    replay.drain(enrich)
    replay.products(("p1", "renamed", "d", "$1"), ("p2", "two", "d", "$2"))
    replay.add("clicks", click("c3", "u", 1, "p2"), click("c4", "u", 1, "p1"))
    replay.drain(enrich)
    table = replay.table("enriched_clicks")
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schemas.ENRICHED_CLICKS]
    assert rows(table.select("click_id", "product_name")) == Counter([("c1", "one"), ("c3", "two"), ("c4", "renamed")])


def test_a_micro_batch_broadcasts_no_dimension_beyond_the_limit(replay, spark):
    """The files of a copy are small, so Spark's own estimate would have it broadcast in every micro-batch."""
    spark.range(200_000).select(
        F.col("id").cast("string").alias("product_id"), F.lit("a product's name").alias("product_name"),
        F.lit("brand type").alias("description"), F.lit("$1.00").alias("price"),
    ).coalesce(1).write.parquet(replay.config.dimension_path)
    replay.add("clicks", click("c1", "u", 0, "7"), click("c2", "u", 0, "x"))
    batch = read_events(spark, "clicks", "files", path=replay.config.event_paths["clicks"], stream=False)
    with enrich.dimension_copies(spark, replay.config).reading() as (products, size):
        joined = enrich.build(batch, products, schemas.ENRICHED_CLICKS, size)
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows(joined.select("click_id", "product_name")) == Counter([("c1", "a product's name")])


def test_lookup_join_of_a_stream_with_a_static_dimension(replay, spark):
    replay.products(("p1", "one", "d", "$1"), ("p1", "one again", "d", "$1"))
    replay.add("clicks", click("c1", "u", 0, "p1"), click("c2", "u", 0, "p2"))
    joined = lookup_join(replay.config.events(spark, "clicks"), replay.config.products(spark))
    query = (
        joined.writeStream.format("memory").queryName("looked_up").trigger(availableNow=True)
        .option("checkpointLocation", f"{replay.folder}/looked_up").start()
    )
    query.awaitTermination()
    assert rows(spark.table("looked_up").select("click_id", "product_name")) == Counter(
        [("c1", "one"), ("c1", "one again")])


def test_a_batch_run_again_replaces_its_first_try(replay, spark):
    table = replay.config.table("again", "rows")
    schema = schemas.USERS
    ensure_batch_table(spark, table, schema, warehouse=replay.config.warehouse)
    overwrite_batch(spark.createDataFrame([("a", "1"), ("b", "1")], schema), table, 0, "stream_x")
    overwrite_batch(spark.createDataFrame([("c", "1")], schema), table, 1, "stream_x")
    overwrite_batch(spark.createDataFrame([("d", "1")], schema), table, 0, "stream_y")
    overwrite_batch(spark.createDataFrame([("a", "2")], schema), table, 0, "stream_x")
    assert rows(spark.table(table)) == Counter([("a", "2"), ("c", "1"), ("d", "1")])
    overwrite_batch(spark.createDataFrame([], schema), table, 0, "stream_x")
    assert rows(spark.table(table)) == Counter([("c", "1"), ("d", "1")])


def test_merging_batches_keeps_the_rows_and_survives_a_crash(replay, spark, monkeypatch):
    table = replay.config.table("merge", "users")
    warehouse = replay.config.warehouse
    ensure_batch_table(spark, table, schemas.USERS, warehouse=warehouse)
    expected = Counter()

    def write(batch_id, run="stream_old"):
        overwrite_batch(spark.createDataFrame([(f"u{run}{batch_id}", "n")], schemas.USERS), table, batch_id, run)
        expected[(f"u{run}{batch_id}", "n")] += 1

    def single():
        return {p for p in _partitions(spark, f"{table}_batches") if not p[0].startswith("merged_")}

    merge_batches(spark, table)
    for batch_id in range(4):
        write(batch_id)
    merge_batches(spark, table)
    assert rows(spark.table(table)) == expected
    # A new checkpoint counts from 0 again.
    for batch_id in range(2):
        write(batch_id, "stream_new")
    append_table(spark.createDataFrame([("backfill", "n")], schemas.USERS), table, schemas.USERS, warehouse=warehouse)
    expected[("backfill", "n")] += 1
    assert rows(spark.table(table)) == expected

    def crash(*args):
        raise RuntimeError("before the view is replaced")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_publish_view", crash)
        with pytest.raises(RuntimeError):
            merge_batches(spark, table)
    assert rows(spark.table(table)) == expected
    for _ in range(3):
        merge_batches(spark, table)
        ensure_batch_table(spark, table, schemas.USERS, warehouse=warehouse)
        assert rows(spark.table(table)) == expected
    assert single() == {("stream_old", 3), ("stream_new", 1)}
    write(4, "stream_old")
    merge_batches(spark, table)
    merge_batches(spark, table)
    assert rows(spark.table(table)) == expected
    assert single() == {("stream_old", 4), ("stream_new", 1)}
    assert spark.table(table).columns == schemas.USERS.names


def test_tiered_merges_bound_partitions_files_and_the_view(replay, spark):
    table = replay.config.table("tiers", "users")
    warehouse = replay.config.warehouse
    ensure_batch_table(spark, table, schemas.USERS, warehouse=warehouse)
    views = []
    for batch_id in range(50):
        frame = spark.createDataFrame([(f"u{batch_id}", str(i)) for i in range(4)], schemas.USERS)
        overwrite_batch(frame.repartition(4).hint("rebalance"), table, batch_id, "stream_x")
        if batch_id % 2:
            assert not merge_batches(spark, table, fanout=3)
            views.append(len(spark.sql(f"SHOW CREATE TABLE {table}").first()[0]))
    gathered = [run for run, _ in _partitions(spark, f"{table}_batches") if run.startswith("merged_")]
    # 25 merges: fewer than 3 of each of 3 levels, and what the last merge replaced.
    levels = Counter(run.split("_")[1] for run in gathered)
    assert set(levels) <= {"0", "1", "2"}
    assert len(_partitions(spark, f"{table}_batches")) <= 12
    merge_batches(spark, table, fanout=3)
    shown = spark.table(table)
    assert shown.count() == 200 and shown.distinct().count() == 200
    assert len({r[0] for r in shown.select(F.input_file_name()).distinct().collect()}) <= 8
    assert max(views[10:]) <= max(views[:10]) + 200, "the view's text does not grow with the number of merges"


def test_a_merge_names_a_bounded_number_of_runs(replay, spark):
    table = replay.config.table("many", "users")
    for i in range(7):
        append_table(
            spark.createDataFrame([(f"u{i}", "n")], schemas.USERS), table, schemas.USERS, warehouse=replay.config.warehouse)
    calls = 0
    while merge_batches(spark, table, most_runs=3):
        record = spark.sql(f"SHOW TBLPROPERTIES {table} ('merged_runs')").first()["value"]
        assert record.count("append_") == 3
        calls += 1
    assert calls == 2 and spark.table(table).count() == 7
    merge_batches(spark, table)
    assert not any(run.startswith("append_") for run, _ in _partitions(spark, f"{table}_batches"))


def test_one_process_merges_at_a_time(replay, spark):
    table = replay.config.table("locked", "users")
    for i in range(2):
        append_table(
            spark.createDataFrame([(f"u{i}", "n")], schemas.USERS), table, schemas.USERS, warehouse=replay.config.warehouse)
    before = _partitions(spark, f"{table}_batches")
    with sinks._only_merge(spark, table, 3600) as mine:
        assert mine
        assert not merge_batches(spark, table)
        assert _partitions(spark, f"{table}_batches") == before
        # A merge that died long ago holds nobody up.
        merge_batches(spark, table, stale_seconds=-1)
    assert len(_partitions(spark, f"{table}_batches")) == 3
    assert spark.table(table).count() == 2


def test_a_table_takes_rows_from_itself(replay, spark):
    table = replay.config.table("self", "users")
    append_table(
        spark.createDataFrame([("u", "n")], schemas.USERS), table, schemas.USERS, warehouse=replay.config.warehouse)
    for expected in (2, 4):
        append_table(spark.table(table), table, schemas.USERS, warehouse=replay.config.warehouse)
        assert spark.table(table).count() == expected


def test_a_stream_merges_its_own_table_and_keeps_commits_small(replay, spark):
    replay.config = replace(replay.config, merge_every=2, merge_fanout=2)
    for i in range(8):
        replay.add("clicks", *[click(f"c{i}{k}", "u", 20 * i + k, f"p{k}") for k in range(6)])
    replay.add("clicks", click("last", "u", 1000))
    replay.drain(product_clicks)
    assert replay.table("products_clicks_5min").count() == 48
    batches = f"{replay.config.table('window_agg_db', 'products_clicks_5min')}_batches"
    assert any(run.startswith("merged_") for run, _ in _partitions(spark, batches))
    files = spark.table(batches).select("run", "batch_id", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("run", "batch_id").count().agg(F.max("count")).first()[0] == 1


def test_jdbc_append_returns_the_ids_it_wrote(spark):
    """The rows' ids are drawn at random, so reading them again would give others."""
    written = []

    def write(rows, table, options, batch_size):
        assert (table, options, batch_size) == ("users", {"url": "jdbc:x"}, 1000)
        written.append(sorted(r.user_id for r in rows.collect()))
        if len(written) == 1:
            raise RuntimeError("connection lost")

    drawn = F.udf(lambda i: uuid.uuid4().hex).asNondeterministic()
    users = spark.range(50).select(drawn("id").alias("user_id"), F.lit("n").alias("username"))
    stage = f"users-{uuid.uuid4().hex}"
    with pytest.raises(RuntimeError):
        jdbc_append(users, "users", {"url": "jdbc:x"}, stage=stage, write=write)
    ids = jdbc_append(users, "users", {"url": "jdbc:x"}, stage=stage, write=write)
    assert sorted(r.user_id for r in ids.collect()) == written[1] == written[0]
    other = jdbc_append(users, "users", {"url": "jdbc:x"}, write=write)
    assert sorted(r.user_id for r in other.collect()) == written[2] != written[1]


@pytest.mark.parametrize("salts, least", [(1, 1), (8, 4)])
def test_salts_spread_a_hot_user_over_state_partitions(replay, spark, salts, least):
    """All rows are of one user and hour: its clicks are kept in one partition, or in several."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    replay.config = replace(replay.config, join_salts=salts)
    replay.add("clicks", *[click(f"c{i}", "u", 60 + i % 50, offset=i) for i in range(64)])
    replay.add("checkouts", checkout("k1", "u", 115))
    replay.drain(checkout_clicks)
    assert replay.table("checkouts_clicks").count() == 64
    state = spark.read.format("statestore").option("joinSide", "right").load(
        replay.config.checkpoint("checkouts_clicks"))
    kept = {r.partition_id: r.n for r in state.groupBy("partition_id").agg(F.count("*").alias("n")).collect()}
    assert len(kept) >= least and (salts > 1 or len(kept) == 1)


def test_salted_left_join_emits_each_checkout(replay, spark):
    replay.add("clicks", *[click(f"c{i}", "u", i, offset=i) for i in range(6)])
    replay.add("checkouts", checkout("k1", "u", 10), checkout("k2", "v", 10))
    replay.add("clicks", click("far", "z", 20 * HOUR))
    replay.add("checkouts", checkout("far", "y", 20 * HOUR))
    config = replay.config
    pairs = checkout_clicks.build(config.events(spark, "clicks"), config.events(spark, "checkouts"), how="left", salts=3)
    config.append(pairs, "checkouts_clicks").awaitTermination()
    got = rows(replay.table("checkouts_clicks").select("checkout_id", "click_id"))
    assert got == Counter([*[("k1", f"c{i}") for i in range(6)], ("k2", None)])


def test_replayed_jobs_take_several_micro_batches(spark, monkeypatch):
    batches = []
    before = contract._run

    def counting(*args):
        started = before(*args)
        batches.extend(sum(p.numInputRows > 0 for p in query.recentProgress) for query in started)
        return started

    monkeypatch.setattr(contract, "_run", counting)
    contract.queries()["stream_replay_tumbling_5s"](spark, TABLES_DIR)
    contract.queries()["stream_restart_interval_1h"](spark, TABLES_DIR)
    assert batches[0] >= 4 and len(batches) == 3 and batches[1] + batches[2] >= 4


def test_batch_append_adds_by_position(replay, spark):
    table = replay.config.table("batch", "users")
    df = spark.createDataFrame([("u", "name")], "x string, y string")
    for _ in range(2):
        append_table(df, table, schemas.USERS, warehouse=replay.config.warehouse)
    assert rows(spark.table(table)) == Counter({("u", "name"): 2})


def test_one_failing_query_stops_the_job(replay, spark):
    def fail(batch, batch_id):
        raise RuntimeError("broken sink")

    replay.add("clicks", click("c", "u", 0))
    events = replay.config.events(spark, "clicks")
    broken = events.writeStream.foreachBatch(fail).option("checkpointLocation", f"{replay.folder}/broken").start()
    healthy = (
        events.writeStream.format("noop").option("checkpointLocation", f"{replay.folder}/healthy")
        .trigger(processingTime="1 second").start()
    )
    with pytest.raises(Exception, match="broken sink"):
        await_all([healthy, broken], poll_seconds=1)
    assert not healthy.isActive


def test_zones(spark):
    create_zones(spark)
    create_zones(spark)
    assert set(ZONES) <= {d.name for d in spark.catalog.listDatabases()}


def test_backfills_streams_and_new_checkpoints_share_a_table(spark, replay, work_dir):
    config = replay.config

    def frame(name):
        return spark.createDataFrame([(name, "n")], schemas.USERS)

    def append(table, name):
        append_table(frame(name), table, schemas.USERS, warehouse=config.warehouse)

    def stream(table, name, checkpoint):
        folder = f"{work_dir}/input-{checkpoint}"
        frame(name).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schemas.USERS).parquet(folder)
        append_stream(
            source, table, schemas.USERS, f"{work_dir}/{checkpoint}", None, warehouse=config.warehouse).awaitTermination()

    def names(table):
        return sorted(r[0] for r in spark.table(table).collect())

    first, second = (config.table("shared", t) for t in ("first", "second"))
    append(first, "b")
    stream(first, "s", "c1")
    assert names(first) == ["b", "s"]
    stream(second, "s", "c2")
    append(second, "b")
    stream(second, "s2", "c3")
    stream(second, "t", "c2")
    assert names(second) == ["b", "s", "s2", "t"]
    merge_batches(spark, second)
    stream(second, "s4", "c4")
    merge_batches(spark, second)
    stream(second, "u", "c2")
    assert names(second) == ["b", "s", "s2", "s4", "t", "u"]


def test_a_new_enrichment_checkpoint_keeps_the_old_rows(replay):
    replay.products(("p1", "one", "d", "$1"))
    replay.add("clicks", click("c1", "u", 0))
    replay.drain(enrich)
    replay.config.checkpoint_root += "-new"
    replay.drain(enrich)
    assert rows(replay.table("enriched_clicks").select("click_id")) == Counter({("c1",): 2})


def test_a_plain_table_of_the_name_is_refused(replay, spark):
    table = replay.config.table("plain", "users")
    ensure_table(spark, table, schemas.USERS, warehouse=replay.config.warehouse)
    with pytest.raises(ValueError):
        ensure_batch_table(spark, table, schemas.USERS, warehouse=replay.config.warehouse)
    with pytest.raises(ValueError):
        append_table(spark.createDataFrame([("u", "n")], schemas.USERS), table, schemas.USERS)
