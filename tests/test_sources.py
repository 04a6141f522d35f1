"""Sources, dimension copies, settings and published records."""

import json
import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from fixtures import BASE, at, checkout, click, frame, rows, stored_schema
from pyspark.sql import functions as F

from clicktide import schemas, session
from clicktide.plans.config import JobConfig, config_from
from clicktide.sources import DimensionSnapshot, Replay, read_dimension, read_events, register_views, uuid_ranges
from clicktide.sources.events import decode_framed_avro, decode_topic
from clicktide.streaming.publish import encode_framed_avro, topic_records


def as_json(event, kind):
    return F.to_json(event).cast("binary")


def from_json(value, kind):
    return F.from_json(value.cast("string"), schemas.EVENTS[kind])


def test_avro_schemas_match_the_entities():
    wire = json.loads(schemas.avro_schema("clicks"))
    assert wire["type"] == "record" and wire["name"] == "Click"
    assert [(f["name"], f["type"]) for f in wire["fields"]][-2:] == [("ip", "string"), ("event_time", "double")]
    assert len(json.loads(schemas.avro_schema("checkouts"))["fields"]) == 10


@pytest.mark.parametrize("kind, row", [("clicks", click("c", "u", 1.5)), ("checkouts", checkout("k", "u", 2.5))])
def test_published_records_decode_to_the_same_events(spark, kind, row):
    events = frame(spark, kind, [row])
    records = topic_records(events, kind, as_json)
    assert records.columns == ["key", "value"]
    raw = records.select(
        "*", F.lit(kind).alias("topic"), F.lit(3).alias("partition"), F.lit(41).cast("bigint").alias("offset"),
        F.lit(at(9)).alias("timestamp"), F.lit(0).alias("timestampType"))
    decoded = decode_topic(raw, kind, from_json)
    assert decoded.columns == schemas.EVENTS[kind].names + schemas.METADATA.names + ["proc_time"]
    assert decoded.schema["partition_id"].dataType.simpleString() == "bigint"
    got = decoded.first()
    names = schemas.EVENTS[kind].names
    assert tuple(got[n] for n in names) == row[: len(names)]
    assert (got["partition_id"], got["offset"], got["topic_id"], got["enqueued_at"]) == (3, 41, kind, at(9))
    assert bytes(raw.first()["key"]) == b"u"


def test_avro_values_carry_the_registry_frame(spark, monkeypatch):
    """The Avro package is not at hand, so JSON stands in for the bytes inside the frame."""
    monkeypatch.setattr("pyspark.sql.avro.functions.to_avro", lambda event, schema: F.to_json(event).cast("binary"))
    monkeypatch.setattr(
        "pyspark.sql.avro.functions.from_avro",
        lambda body, schema, options: F.from_json(body.cast("string"), schemas.CLICKS))
    events = frame(spark, "clicks", [click("c", "u", 1.5)])
    values = topic_records(events, "clicks", encode_framed_avro(258))
    assert bytes(values.first()["value"])[:6] == b"\x00\x00\x00\x01\x02{"
    decoded = values.select(decode_framed_avro(F.col("value"), "clicks").alias("e")).select("e.*")
    assert decoded.columns == schemas.CLICKS.names
    assert rows(decoded) == rows(events.select(schemas.CLICKS.names))


def test_files_replay_as_batch_and_stream(spark, work_dir):
    path = f"{work_dir}/clicks"
    spark.createDataFrame([click("c", "u", 1)], stored_schema("clicks")).write.parquet(path)
    batch = read_events(spark, "clicks", "files", path=path, stream=False)
    stream = read_events(spark, "clicks", "files", path=path)
    assert stream.isStreaming and not batch.isStreaming
    assert stream.columns == batch.columns
    assert batch.first()["event_time"] == BASE + 1


def test_unknown_kinds_and_sources_are_refused(spark):
    with pytest.raises(ValueError):
        read_events(spark, "views", "files", path="x")
    with pytest.raises(ValueError):
        read_events(spark, "clicks", "socket")
    with pytest.raises(ValueError):
        read_dimension(spark, "products", "socket")


def test_ranges_cover_every_id_once(spark):
    ids = spark.createDataFrame(
        [(None,), ("",), ("0a",), ("1",), ("17",), ("9f",), ("a0",), ("f",), ("ff",), ("zz",), ("é",)], "product_id string")
    parts = uuid_ranges("product_id")
    assert len(parts) == 16
    found = Counter()
    for predicate in parts:
        found += rows(ids.where(predicate))
    assert found == rows(ids)
    assert uuid_ranges("product_id", []) == ["1 = 1"]


def test_jdbc_dimension_reads_ranges_with_credentials_from_options(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, predicates=None, properties=None, **_):
        seen.update(url=url, table=table, predicates=predicates, properties=properties)
        return spark.createDataFrame([("u1", "name", "secret")], "user_id string, username string, password string")

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.jdbc", jdbc)
    users = read_dimension(spark, "users", options={"url": "jdbc:x", "user": "a", "password": "b"})
    assert users.columns == ["user_id", "username"]
    assert seen["url"] == "jdbc:x" and seen["table"] == "users" and len(seen["predicates"]) == 16
    assert seen["properties"]["fetchsize"] == "10000" and seen["properties"]["user"] == "a"


def _growing_dimension(spark):
    """A reader that gives one more product each time it is asked, and how often it was."""
    reads = []

    def read():
        reads.append(1)
        return spark.createDataFrame([(f"p{i}", "n", "d", "$1") for i in range(len(reads))], schemas.PRODUCTS)

    return read, reads


def test_dimension_copy_is_kept_for_its_ttl(spark, work_dir):
    now = [0.0]
    read, reads = _growing_dimension(spark)
    copies = DimensionSnapshot(spark, read, f"{work_dir}/dimension", "10 minutes", lambda: now[0])
    with copies.reading() as (first, size):
        assert first.count() == 1 and size > 0
        now[0] = 599.0
        with copies.reading() as (same, _):
            assert same.count() == 1 and len(reads) == 1
        for expected in (2, 3, 4):
            now[0] += 600.0
            with copies.reading() as (newer, larger):
                assert newer.count() == expected and larger > size and len(reads) == expected
        assert first.count() == 1, "a batch still using a former copy must keep it"
    # Folders of copies that nobody reads are written again.
    assert sorted(os.listdir(f"{work_dir}/dimension")) == ["copy-0", "copy-1", "copy-2"]


def test_streams_share_a_dimension_copy(spark, work_dir):
    """Four threads ask at once, twice: the database is read once per age."""
    now = [0.0]
    read, reads = _growing_dimension(spark)
    copies = DimensionSnapshot(spark, read, f"{work_dir}/shared-dimension", "10 minutes", lambda: now[0])

    def rows(_):
        with copies.reading() as (products, _):
            return products.count()

    with ThreadPoolExecutor(4) as pool:
        for age in (1, 2):
            assert list(pool.map(rows, range(4))) == [age] * 4
            assert len(reads) == copies.copies == age
            now[0] += 600.0


def test_replay_publishes_steps_in_event_time_order(spark, work_dir):
    events = frame(spark, "clicks", [click(f"c{i}", "u", (i * 37) % 100, offset=i) for i in range(100)])
    replay = Replay(
        events, "clicks", f"{work_dir}/replay", steps=5, files_per_step=2, late=F.col("click_id") == "c0")
    seen = 0
    highest = 0.0
    for step in range(5):
        replay.publish(1)
        stored = read_events(spark, "clicks", "files", path=replay.path, stream=False)
        assert stored.columns == [*schemas.CLICKS.names, *schemas.METADATA.names, "proc_time"]
        times = sorted(r.event_time for r in stored.collect())
        assert len(times) > seen and (step == 0 or times[seen] >= highest)
        seen, highest = len(times), times[-1]
    assert seen == 99
    replay.publish()
    replay.publish_late()
    assert read_events(spark, "clicks", "files", path=replay.path, stream=False).count() == 100
    fixed = Replay(events, "clicks", f"{work_dir}/fixed", steps=2, borders=[float(BASE + 90)])
    fixed.publish(1)
    assert read_events(spark, "clicks", "files", path=fixed.path, stream=False).count() == 90


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_work_dir(spark, "x") != session.new_work_dir(spark, "x")


def test_catalog_settings_take_secrets_from_the_environment(monkeypatch):
    monkeypatch.delenv("LAKE_S3_ACCESS_KEY", raising=False)
    conf = session.lake_catalog_conf("lake", "http://catalog/api", "s3://bucket", s3_endpoint="http://s3", region="r")
    assert conf["spark.sql.catalog.lake.ref"] == "main"
    assert conf["spark.sql.defaultCatalog"] == "lake"
    assert not any("access-key" in key for key in conf)
    monkeypatch.setenv("LAKE_S3_ACCESS_KEY", "a")
    monkeypatch.setenv("LAKE_S3_SECRET_KEY", "b")
    conf = session.lake_catalog_conf("lake", "http://catalog/api", "s3://bucket")
    assert conf["spark.sql.catalog.lake.s3.secret-access-key"] == "b"


def test_job_settings(spark, monkeypatch):
    monkeypatch.setenv("DIMENSION_USER", "u")
    monkeypatch.setenv("DIMENSION_PASSWORD", "w")
    spark.conf.set("spark.clicktide.kafka.bootstrapServers", "broker:9092")
    spark.conf.set("spark.clicktide.jdbc.url", "jdbc:postgresql://db/shop")
    config = config_from(spark)
    assert config.event_options["kafka.bootstrap.servers"] == "broker:9092"
    assert "maxOffsetsPerTrigger" in config.event_options
    assert config.dimension_options["user"] == "u"
    assert (config.commit_interval, config.dimension_ttl) == ("10 seconds", "10 minutes")
    assert config.checkpoint("x").startswith(session.shared_dir(spark))
    assert JobConfig(database_prefix="t_").table("db", "x") == "t_db.x"
    assert (config.window, config.lookback, config.gap, config.dimension_bounds) == ("5 seconds", "1 hour", "10 seconds", None)
    given = {
        "runOnce": "true", "window": "1 minute", "window.delay": "2 minutes", "lookback": "2 hours", "join.delay": "3 hours",
        "join.salts": "4", "gap": "30 seconds", "session.delay": "5 hours", "mergeEvery": "20", "mergeFanout": "5",
        "statePartitions": "64", "jdbc.bounds": "g,n,t", "databasePrefix": "dev_", "warehouse": "s3a://lake/dev"}
    for key, value in given.items():
        spark.conf.set(f"spark.clicktide.{key}", value)
    try:
        config = config_from(spark)
    finally:
        for key in given:
            spark.conf.unset(f"spark.clicktide.{key}")
    assert config.commit_interval is None and config.dimension_bounds == ["g", "n", "t"]
    assert (config.window, config.window_delay, config.lookback, config.join_delay) == (
        "1 minute", "2 minutes", "2 hours", "3 hours")
    assert (config.join_salts, config.gap, config.session_delay) == (4, "30 seconds", "5 hours")
    assert (config.merge_every, config.merge_fanout, config.state_partitions) == (20, 5, 64)
    assert (config.table("db", "x"), config.warehouse) == ("dev_db.x", "s3a://lake/dev")


def test_views_make_frames_queryable(spark):
    register_views({"clicks_view": frame(spark, "clicks", [click("c", "u", 0, "p1")])})
    assert spark.sql("SELECT count(*) AS n FROM clicks_view WHERE product_id = 'p1'").first()["n"] == 1
