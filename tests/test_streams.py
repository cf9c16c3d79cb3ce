import json

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.session import scratch_dir
from riskloom.streaming import flows as R
from riskloom.streaming import sync as Y
from riskloom.streaming.trailing import trailing_stream

SCHEMA = "partition int, offset bigint, value string"
ROWS = [
    (0, 0, '{"a": 1}'), (0, 1, "{bad"), (0, 2, '{"a": 1} x'), (1, 0, '{"a": 1, "a": 2}'), (1, 1, '{"a": NaN}'), (1, 2, None), (2, 0, "12"), (2, 1, ""),
]
DEAD = {(0, 1), (0, 2), (1, 2), (2, 1)}


def positions(df):
    return {(r.partition, r.offset) for r in df.collect()}


def test_split_follows_the_json_decoder(spark):
    main, dead = Y.dlq_split(spark.createDataFrame(ROWS, SCHEMA))
    assert positions(dead) == DEAD and positions(main) == {(p, o) for p, o, _ in ROWS} - DEAD
    report = json.loads(dead.filter("partition = 0 AND offset = 1").first().payload)
    assert report["original_payload"] == "{bad" and report["error_message"]


def test_bytes_that_are_no_utf8(spark):
    rows = spark.createDataFrame([(0, 0, b'{"a": "\xff"}'), (0, 1, b'{"a": "\xc3\xa9"}')], "partition int, offset bigint, value binary")
    main, dead = Y.dlq_split(rows)
    assert positions(main) == {(0, 1)}
    assert json.loads(dead.first().payload)["original_payload"] == '{"a": "�"}'


def write_log(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(path)


def test_replays_add_nothing_and_partitions_do_not_mix(spark):
    path, main, dead = (scratch_dir(spark, p) for p in ("log", "main", "dead"))
    write_log(spark, ROWS, path)

    def run(checkpoint):
        Y.start_sync(R.read_log_topic(spark, path, schema=SCHEMA), main, dead, checkpoint).awaitTermination()

    first = scratch_dir(spark, "cp")
    run(first)
    assert positions(Y.read_table(spark, dead)) == DEAD
    run(first)  # nothing new
    run(scratch_dir(spark, "cp"))  # full replay by a new consumer
    write_log(spark, [(0, 3, "{}"), (0, 0, "{}")], path)  # one new row, one repeated position
    run(first)
    m, d = Y.read_table(spark, main), Y.read_table(spark, dead)
    assert m.count() == len(ROWS) - len(DEAD) + 1 and d.count() == len(DEAD)
    assert m.filter("partition = 0 AND offset = 0").first().payload == '{"a": 1}'
    gap = Y.sync_gap(spark.read.schema(SCHEMA).json(path), m, d)
    assert {r.gap for r in gap.collect()} == {0} and Y.total_gap(gap).first().lagging is False


def test_a_repeated_batch_overwrites_itself(spark):
    main, dead = scratch_dir(spark, "main"), scratch_dir(spark, "dead")
    Y.ensure_tables(spark, main, dead)
    write = Y.sync_batch(main, dead)
    batch = spark.createDataFrame(ROWS, SCHEMA)
    write(batch, 0)
    write(batch, 0)
    assert Y.read_table(spark, main).count() == len(ROWS) - len(DEAD)


def test_audit_stops(spark):
    path = scratch_dir(spark, "log")
    write_log(spark, ROWS, path)
    gone = [(0, 9, "{}")]  # offsets 3..8 were never written, so the gap cannot close
    write_log(spark, gone, path)
    report = Y.audit(
        lambda: R.read_log_topic(spark, path, schema=SCHEMA), spark.read.schema(SCHEMA).json(path),
        scratch_dir(spark, "main"), scratch_dir(spark, "dead"), scratch_dir(spark, "cp"),
    )
    assert report == [(1, 9, 6, "Retrying"), (2, 0, 6, "Synced")]


def test_offsets_of_empty_tables(spark):
    none = spark.createDataFrame([], "partition int, offset bigint")
    assert Y.max_offset(none, none).first()[0] == 0
    assert tuple(Y.watermark_summary(none).first()) == (0, 0)


def test_late_rows_are_dropped(spark):
    path = scratch_dir(spark, "clicks")
    schema = "ts timestamp, user_id int"
    cp, out = scratch_dir(spark, "cp"), scratch_dir(spark, "out")

    def add(*rows):
        spark.createDataFrame(rows, "ts string, user_id int").select(F.to_timestamp("ts").alias("ts"), "user_id").coalesce(1).write.mode("append").parquet(path)

    def run():
        counts = R.windowed_velocity(spark.readStream.schema(schema).parquet(path), "ts", "user_id", late="10 minutes", window="1 hour", slide="1 hour")
        counts.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()

    add(("2024-01-01 00:10:00", 1), ("2024-01-01 00:20:00", 1), ("2024-01-01 03:00:00", 2))
    run()
    add(("2024-01-01 00:30:00", 1), ("2024-01-01 09:00:00", 2))  # the first one is too late
    run()
    got = {(str(r.window_start), r.user_id): r.velocity for r in spark.read.parquet(out).collect()}
    assert got == {("2024-01-01 00:00:00", 1): 2, ("2024-01-01 03:00:00", 2): 1}


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        R.read_log_topic(spark, "topic", servers="nowhere:9092")


def test_tables_as_one_file_or_a_folder(spark, sf):
    path = scratch_dir(spark, "tables")
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(f"{path}/events.parquet")
    for folder in (sf, path):
        stream = R.stream_table(spark, folder, "events").select("event_id")
        assert R.run_to_files(stream, "copy").distinct().count() == events.count()


def test_a_payload_nested_too_deeply_is_a_dead_letter(spark):
    rows = spark.createDataFrame([(0, 0, "[" * 200_000), (0, 1, "{}")], "partition int, offset long, value string")
    from riskloom.streaming import sync

    main, dead = sync.dlq_split(rows)
    assert [r.offset for r in main.collect()] == [1] and [r.offset for r in dead.collect()] == [0]


TEXTS = [
    '{"a": 1}', ' [1, 2.5e3, null, "x"] ', '"s"', "12", "-0.5", "true", "null", "", " ", "1 2", "1, 2", '1, "b": 2', '{"a": 1} x',
    "] [", "}{", '1}, "a":{', "1], [2", '"x": 1', '{"a": 1, "a": 2}', "NaN", "-Infinity", "{'a': 1}", '{"a": 01}', '{a: 1}', "[1,]",
    '"\\ud800"', '"\\u00zz"', '"tab\tinside"', "﻿{}", '{"a": 1}\u0000', "/* c */ 1", "[" * 1200 + "]" * 1200, "[" * 50 + "]" * 50,
    "9" * 5000, "1.", "+1", "1e5", '"é😀"', '[1] // c', "tru", '{"a" 1}', '{"a": {"b": [1, {"c": null}]}}',
]


def test_native_check_never_clears_what_the_decoder_rejects(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, value string")
    sure = {r.k: r.sure for r in rows.select("k", Y.surely_json(F.col("value")).alias("sure")).collect()}
    dead = {r.k: r.error is not None for r in rows.select("k", Y.json_error(F.col("value")).alias("error")).collect()}
    for k, text in enumerate(TEXTS):
        try:
            json.loads(text)
            valid = True
        except Exception:
            valid = False
        assert dead[k] is not valid, text
        assert valid or not sure[k], text
    ordinary = [0, 1, 2, 3, 4, 5, 6, 32, 36, 37, 41]
    assert all(sure[k] for k in ordinary)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text('{}[]:,"a1 .\\\n', max_size=12), min_size=200, max_size=300))
def test_native_check_on_random_texts(spark, texts):
    def valid(text):
        try:
            json.loads(text)
            return True
        except Exception:
            return False

    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, value string")
    assert all(valid(texts[r.k]) for r in rows.filter(Y.surely_json(F.col("value"))).select("k").collect())


def test_only_doubtful_texts_reach_the_decoder(spark, sf):
    from riskloom.plans import views as V

    log = V.log(spark, sf)
    seen = log.select(Y.doubtful(F.col("value")).alias("t")).filter("t IS NOT NULL").count()
    dead = Y.checked(log).filter("error IS NOT NULL").count()
    assert dead <= seen < log.count() / 10


def test_dead_letters_reach_the_topic_once(spark, monkeypatch):
    """The writer ends between the sinks, at each of them; the repeated batch completes every one."""
    batch = spark.createDataFrame(ROWS, SCHEMA)
    for sink in range(3):
        main, dead, topic = (scratch_dir(spark, p) for p in ("main", "dead", "topic"))
        Y.ensure_tables(spark, main, dead)
        write = Y.sync_batch(main, dead, topic)
        calls, append, publish = [], Y.append_new, Y.publish_new

        def ending(own):
            def run(*args):
                if len(calls) == sink:
                    raise RuntimeError("ended here")
                calls.append(own)
                own(*args)
            return run

        monkeypatch.setattr(Y, "append_new", ending(append))
        monkeypatch.setattr(Y, "publish_new", ending(publish))
        with pytest.raises(RuntimeError, match="ended here"):
            write(batch, 0)
        monkeypatch.undo()
        write(batch, 0)
        write(batch, 1)
        assert Y.read_table(spark, main).count() == len(ROWS) - len(DEAD)
        assert Y.read_table(spark, dead).count() == len(DEAD)
        messages = Y.topic_messages(spark, topic).collect()
        assert sorted(m.key for m in messages) == sorted(f"{p}-{o}" for p, o in DEAD)
        assert all(json.loads(m.value).keys() >= {"error_message"} for m in messages)


def test_small_batches_and_compaction(spark, monkeypatch):
    monkeypatch.setattr(Y, "OFFSETS_PER_RANGE", 10)
    path, main, dead, topic = (scratch_dir(spark, p) for p in ("log", "main", "dead", "topic"))
    for start in range(0, 40, 8):
        write_log(spark, [(o % 2, o, "{}" if o % 5 else "{bad") for o in range(start, start + 8)], path)
    stream = R.read_log_topic(spark, path, schema=SCHEMA, per_batch=1)
    Y.start_sync(stream, main, dead, scratch_dir(spark, "cp"), topic).awaitTermination()
    rows = Y.read_table(spark, main)
    assert rows.count() == 32 and rows.select("batch_id").distinct().count() == 5
    assert {r.offset_range for r in rows.collect()} == {0, 1, 2, 3}
    small = Y.compact(spark, main, scratch_dir(spark, "compact"))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, rows.collect()))
    assert len(small.inputFiles()) < len(rows.inputFiles())
    assert Y.topic_messages(spark, topic).count() == Y.read_table(spark, dead).count() == 8


def test_stage_tables_of_batches_are_removed(spark):
    from riskloom.session import exists, staged

    with staged(spark.range(3), "short") as rows:
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert rows.count() == 3 and exists(spark, folder)
    assert not exists(spark, folder)


def test_stage_tables_are_removed_on_demand(spark):
    from riskloom.session import exists, materialize, remove_stages

    folder = materialize(spark.range(3), "long").inputFiles()[0].rsplit("/", 1)[0]
    assert exists(spark, folder)
    remove_stages(spark)
    assert not exists(spark, folder)


def test_trailing_counts_follow_late_rows(spark):
    path, out = scratch_dir(spark, "events"), scratch_dir(spark, "out")
    cp = scratch_dir(spark, "cp")
    schema = "event_id long, user_id string, ts timestamp"
    seen = []

    def add(*rows):
        batch = spark.createDataFrame(rows, "event_id long, user_id string, ts string")
        batch.select("event_id", "user_id", F.to_timestamp("ts").alias("ts")).coalesce(1).write.mode("append").parquet(path)
        counts = trailing_stream(
            spark.readStream.schema(schema).parquet(path), "user_id", "ts", "event_id", late="2 hours", block_seconds=7200
        )
        seen.clear()
        counts.writeStream.outputMode("update").foreachBatch(lambda df, _: seen.extend(df.collect())).option(
            "checkpointLocation", cp
        ).trigger(availableNow=True).start().awaitTermination()
        return {r.event_id: r.velocity_1h for r in seen}

    assert add((1, "a", "2024-01-01 01:30:00"), (2, "a", "2024-01-01 02:10:00"), (3, "b", "2024-01-01 02:10:00"),
               (4, "a", "2024-01-01 02:31:00")) == {1: 1, 2: 2, 3: 1, 4: 2}
    # A late row between, across the border of two blocks; a row at exactly one hour; nulls.
    assert add((5, "a", "2024-01-01 01:50:00"), (6, "a", "2024-01-01 03:31:00"), (7, None, "2024-01-01 03:00:00"),
               (8, "a", None)) == {5: 2, 2: 3, 4: 3, 6: 2}
    # The watermark moves on: a row of long ago changes nothing, and its block is gone.
    add((9, "b", "2024-01-03 00:00:00"))
    assert add((10, "a", "2024-01-01 02:00:00"), (11, "b", "2024-01-03 00:30:00")) == {11: 2}


def test_trailing_counts_of_many_users_take_few_calls():
    """Users with a few rows share the state and the call of a group; their counts stay apart."""
    from riskloom.streaming import trailing

    class Held(list):
        def get(self):
            return iter(list(self))

        def appendValue(self, row):
            self.append(row)

    counter = trailing.TrailingCounter(10, 100)
    counter.held, timers = Held(), []
    counter.handle = type("Handle", (), {"registerTimer": staticmethod(timers.append)})

    def call(*rows):
        new = pd.DataFrame(rows, columns=["user", "t", "id", "own"])
        got = pd.concat(counter.handleInputRows((0, 0), iter([new]), None))
        return {r.id: (r.user, r.t, r.n) for r in got.itertuples()}

    assert call((b"a", 5, 1, True), (b"b", 5, 2, True), (b"b", 99, 3, True), (b"c", 100, 4, False)) == {
        1: (b"a", 5, 1), 2: (b"b", 5, 1), 3: (b"b", 99, 1)}
    assert call((b"b", 89, 5, True), (b"a", 0, 6, True)) == {5: (b"b", 89, 1), 3: (b"b", 99, 2), 6: (b"a", 0, 1), 1: (b"a", 5, 2)}
    assert len(counter.held) == 2 and timers == [0]


def test_trailing_state_grows_with_days_not_users(spark):
    """5,000 users on two days: as many states as groups and days, not as users and days."""
    path = scratch_dir(spark, "events")
    rows = spark.range(10_000).selectExpr("id AS event_id", "id % 5000 AS user_id", "timestamp_seconds(1704067200 + id * 16) AS ts")
    rows.write.parquet(path)
    counts = trailing_stream(spark.readStream.schema(rows.schema).parquet(path), "user_id", "ts", "event_id", late="9 days", groups=4)
    query = counts.writeStream.outputMode("update").format("noop").option("checkpointLocation", scratch_dir(spark, "cp")).trigger(
        availableNow=True).start()
    query.awaitTermination()
    held = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 0 < max(held) <= 100
