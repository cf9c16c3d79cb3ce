"""Log copies, gaps, envelopes and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.models import documents as D
from riskloom.models.engines import get_engine
from riskloom.operators.behaviour import deviation_from_mean, trailing_count
from riskloom.operators.joins import insert_ignore, pair_sources
from riskloom.plans import views as V
from riskloom.plans.decisions import HEALTH, H_NAMES, PAIR_SQL, model_sql
from riskloom.plans.scalar import r6
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.session import scratch_dir
from riskloom.sources.tables import table
from riskloom.streaming import flows as R
from riskloom.streaming import sync as Y
from riskloom.streaming.trailing import trailing_stream


def split_parts(spark, sf):
    main, dead = Y.dlq_split(V.log(spark, sf))
    return main, dead


# The dead-letter report keeps the decoder's message, which SQL cannot produce; the original text is compared.
SPLIT = """SELECT 'main' AS kind, "partition", "offset", value AS payload FROM log WHERE json_valid(value)
UNION ALL SELECT 'dead', "partition", "offset", value FROM log WHERE NOT json_valid(value)"""


def tagged(main, dead):
    original = F.get_json_object("payload", "$.original_payload")
    return main.select(F.lit("main").alias("kind"), *Y.KEY, "payload").unionByName(
        dead.select(F.lit("dead").alias("kind"), *Y.KEY, original.alias("payload"))
    )


@query("dlq_split", with_views("log", SPLIT))
def dlq_split(spark, sf):
    return tagged(*split_parts(spark, sf))


@query("dlq_messages", with_views("log", """SELECT "partition", "offset", true AS has_message FROM log WHERE NOT json_valid(value)"""))
def dlq_messages(spark, sf):
    _, dead = split_parts(spark, sf)
    return dead.select(*Y.KEY, (F.length(F.get_json_object("payload", "$.error_message")) > 0).alias("has_message"))


@query("decode_replace", """SELECT event_id, CASE WHEN event_id%3=0 THEN NULL ELSE props END AS strict,
  CASE WHEN event_id%3=0 THEN props||chr(65533) ELSE props END AS replaced FROM events""")
def decode_replace(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.col("props").cast("binary"), F.unhex(F.lit("FF"))))
        .otherwise(F.col("props").cast("binary")).alias("value"),
    )
    return rows.select(
        "event_id", Y.decode_strict(F.col("value")).alias("strict"), Y.decode_replace(F.col("value")).alias("replaced")
    )


@query("log_high_watermark", with_views("log", """
SELECT "partition", max("offset")+1 AS end_offset, (SELECT sum(m)::bigint FROM (SELECT max("offset")+1 AS m FROM log GROUP BY "partition")) AS total_end,
  (SELECT max("offset") FROM log) AS max_offset FROM log GROUP BY "partition" """))
def log_high_watermark(spark, sf):
    log = V.log(spark, sf)
    total = Y.watermark_summary(log)
    return Y.high_watermarks(log).select(
        "partition", "end_offset", total.select("total_end").scalar().alias("total_end"),
        total.select("max_offset").scalar().alias("max_offset"),
    )


@query("max_offset_union", with_views("log main_table", """
SELECT coalesce(max("offset"), 0) AS max_offset FROM main_table"""))
def max_offset_union(spark, sf):
    return Y.max_offset(V.synced_rows(spark, sf))


@query("union_distinct", with_views("log main_table", """
SELECT max("offset") AS m FROM main_table UNION SELECT max("offset") AS m FROM log GROUP BY "partition" """))
def union_distinct(spark, sf):
    a = V.synced_rows(spark, sf).agg(F.max("offset").alias("m"))
    b = V.log(spark, sf).groupBy("partition").agg(F.max("offset").alias("m")).select("m")
    return a.union(b).distinct()


@query("union_all_by_name", with_views("txn", """SELECT txn_id, epoch, is_fraud FROM txn WHERE epoch='drift'
UNION ALL SELECT txn_id, epoch, is_fraud FROM txn WHERE epoch='stable'"""))
def union_all_by_name(spark, sf):
    rows = V.txn(spark, sf)
    stable = rows.filter("epoch = 'stable'").select("txn_id", "epoch", "is_fraud")
    return rows.filter("epoch = 'drift'").select("is_fraud", "txn_id", "epoch").unionByName(stable)


@query("sync_gap", with_views("log main_table", """
SELECT "partition", end_offset, synced, end_offset - synced AS gap, end_offset - synced >= 5 AS lagging FROM
  (SELECT "partition", max("offset")+1 AS end_offset FROM log GROUP BY "partition") JOIN
  (SELECT "partition", count(*) AS synced FROM main_table GROUP BY "partition") USING ("partition")"""))
def sync_gap(spark, sf):
    return Y.sync_gap(V.log(spark, sf), V.synced_rows(spark, sf))


@query("sync_gap_total", with_views("log main_table", """
SELECT (SELECT sum(m)::bigint FROM (SELECT max("offset")+1 AS m FROM log GROUP BY "partition")) - count(*) AS gap,
  (SELECT sum(m)::bigint FROM (SELECT max("offset")+1 AS m FROM log GROUP BY "partition")) - count(*) >= 5 AS lagging FROM main_table"""))
def sync_gap_total(spark, sf):
    return Y.total_gap(Y.sync_gap(V.log(spark, sf), V.synced_rows(spark, sf)))


@query("insert_ignore", with_views("log main_table", """SELECT "partition", "offset", value FROM log
WHERE "offset" >= (SELECT max("offset")*0.8::double FROM log)"""))
def insert_ignore_query(spark, sf):
    """A full replay, every row twice, against a table that holds most of it."""
    log = V.log(spark, sf)
    return insert_ignore(V.synced_rows(spark, sf), log.unionByName(log), Y.KEY).select("partition", "offset", "value")


def log_stream(spark, sf):
    """The log as a stream: the same columns as the batch view."""
    e = F.col("event_id")
    return R.stream_table(spark, sf, "events").select(
        (e % 3).cast("int").alias("partition"), F.floor(e / 3).alias("offset"),
        F.when(e % 17 == 0, "{bad").when(e % 101 == 0, '{"a":1} x').when(e % 103 == 0, '{"a":1,"a":2}')
        .otherwise(F.col("props")).alias("value"), "ts",
    )


@query("stream_sync_dlq", with_views("log", SPLIT))
def stream_sync_dlq(spark, sf):
    main, dead = scratch_dir(spark, "sync-main"), scratch_dir(spark, "sync-dead")
    stream = log_stream(spark, sf).drop("ts")
    Y.start_sync(stream, main, dead, scratch_dir(spark, "sync-checkpoint")).awaitTermination()
    return tagged(Y.read_table(spark, main), Y.read_table(spark, dead))


@query("audit_converged", "SELECT 1 AS round, count(*) AS written, 0::bigint AS gap, 'Synced' AS state FROM events")
def audit_converged(spark, sf):
    report = Y.audit(
        lambda: log_stream(spark, sf).drop("ts"), V.log(spark, sf), scratch_dir(spark, "audit-main"),
        scratch_dir(spark, "audit-dead"), scratch_dir(spark, "audit-checkpoint"),
    )
    return spark.createDataFrame(report, "round int, written bigint, gap bigint, state string")


@query("stream_dedup", with_views("log", """SELECT "partition", "offset", value FROM log"""))
def stream_dedup(spark, sf):
    """Every row arrives twice."""
    twice = log_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    once = R.drop_replays(twice.withColumn("ts", F.col("ts").cast("timestamp")), "ts", Y.KEY)
    return R.run_to_files(once.select("partition", "offset", "value"), "dedup")


@query("stream_velocity", """
SELECT time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(10*i) AS window_start, user_id, count(*) AS velocity
FROM events, range(6) r(i) GROUP BY ALL""")
def stream_velocity(spark, sf):
    counts = R.windowed_velocity(R.stream_table(spark, sf, "events"), "ts", "user_id")
    return R.run_updates(counts, ["window_start", "user_id"], "velocity")


@query("stream_velocity_events", """
SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
  AS velocity_1h FROM events""")
def stream_velocity_events(spark, sf):
    """The trailing hour of each event on a stream of several micro-batches, equal to the batch query."""
    path = scratch_dir(spark, "events")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    events.repartition(3, "event_id").write.parquet(f"{path}/events.parquet")  # every batch holds rows of all times
    stream = R.stream_table(spark, path, "events", files_per_batch=1)
    counts = trailing_stream(stream, "user_id", "ts", "event_id", late="60 days")
    return R.run_updates(counts, ["event_id"], "trailing")


@query("stream_score", with_views("infra", f"""
SELECT order_id, round(raw, 9) AS efficiency, CASE WHEN raw > 0.75 THEN 'OK' WHEN raw > 0.45 THEN 'WARN' ELSE 'CRITICAL' END AS status
FROM ({model_sql(HEALTH, H_NAMES, 'infra')}) WHERE cs_auth_status IS NOT NULL"""))
def stream_score(spark, sf):
    """Stored health model on a stream."""
    from riskloom.functions.scalar import health_status

    model = D.PairModel.from_health_document(D.HEALTH_MODEL)

    def score(rows):
        x = rows.filter("cs_auth_status IS NOT NULL").withColumns({
            "x1": F.col("amazon_api_latency") / F.lit(2000.0), "x2": F.col("cs_auth_status"),
            "x3": F.col("system_cpu_load") / F.lit(100.0),
        })
        raw = model.raw_score()
        return x.select("order_id", F.round(raw, 9).alias("efficiency"), health_status(raw).alias("status"))

    stream = V.infra_rows(R.stream_table(spark, sf, "lineitem"))
    return R.run_to_files(R.score_stream(stream, score), "stream-score")


@query("stream_score_pair", with_views("txn", f"""
SELECT txn_id, round(pair_score, 6) AS score, CASE WHEN pair_score > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM ({PAIR_SQL})"""))
def stream_score_pair(spark, sf):
    """The fraud engine on a stream of feature rows."""
    path, rows = scratch_dir(spark, "features"), V.txn(spark, sf).select("txn_id", *V.FEATURES)
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    scored = R.score_stream(stream, lambda df: get_engine("pair_model")(df).select("txn_id", r6("score"), "decision"))
    return R.run_to_files(scored, "stream-score-pair")


FLAT = """SELECT 'order-'||o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ingestion_ts, '2.1' AS schema_version,
  o_orderkey, o_orderstatus, o_custkey, o_totalprice FROM orders"""
SHOP = f"""SELECT 'S-'||o_orderkey AS event_id, 'SHOP' AS source_system, ingestion_ts, schema_version, order_id, o_orderstatus AS order_status,
  'item-'||(o_custkey%500) AS sku, (o_orderkey%3+1)::int AS quantity, NULL::varchar AS decision, NULL::bigint AS amount, NULL::int AS fraud_score FROM ({FLAT})"""
PAY = f"""SELECT 'P-'||o_orderkey, 'PAYMENT', ingestion_ts, schema_version, order_id, NULL, NULL, NULL,
  CASE o_orderkey%3 WHEN 0 THEN 'paid' WHEN 1 THEN 'refused' ELSE 'held' END, floor(o_totalprice)::bigint, (o_custkey%101)::int FROM ({FLAT})"""


@query("envelope_flatten", f"{SHOP} UNION ALL {PAY}")
def envelope_flatten(spark, sf):
    return R.flatten_envelope(V.envelopes(spark, sf))


PAIRED = f"""WITH e AS ({SHOP} UNION ALL {PAY}) SELECT s.order_id, s.event_id AS shop_event, p.event_id AS pay_event, s.quantity, p.decision
FROM e s JOIN e p ON s.order_id = p.order_id AND s.source_system='SHOP' AND p.source_system='PAYMENT'"""


@query("pair_events", PAIRED)
def pair_events(spark, sf):
    flat = R.flatten_envelope(V.envelopes(spark, sf))
    pairs = pair_sources(flat, "order_id", "source_system", "SHOP", "PAYMENT")
    return pairs.select(
        "order_id", F.col("left_event.event_id").alias("shop_event"), F.col("right_event.event_id").alias("pay_event"),
        "left_event.quantity", "right_event.decision",
    )


@query("stream_pair_events", PAIRED)
def stream_pair_events(spark, sf):
    flat = R.flatten_envelope(V.envelope_rows(R.stream_table(spark, sf, "orders")))
    flat = flat.withColumn("at", F.to_timestamp("ingestion_ts"))
    again = R.flatten_envelope(V.envelope_rows(R.stream_table(spark, sf, "orders")))
    again = again.withColumn("at", F.to_timestamp("ingestion_ts"))
    pairs = R.pair_streams(
        flat.filter("source_system = 'SHOP'"), again.filter("source_system = 'PAYMENT'"), "order_id", "at"
    )
    flat_pairs = pairs.select(
        "order_id", F.col("left_event.event_id").alias("shop_event"), F.col("right_event.event_id").alias("pay_event"),
        "left_event.quantity", "right_event.decision",
    )
    return R.run_to_files(flat_pairs, "pair-events")


@query("stream_partition_key", """SELECT 'order-'||o_orderkey AS key, 2::bigint AS n_events, 1::bigint AS n_partitions FROM orders""")
def stream_partition_key(spark, sf):
    """Events of one key share a partition."""
    placed = V.envelopes(spark, sf).repartition("key").withColumn("p", F.spark_partition_id())
    return placed.groupBy("key").agg(F.count("*").alias("n_events"), F.count_distinct("p").alias("n_partitions"))


@query("sink_log_topic", """SELECT event_id::varchar AS key, event_id, event_type, round(value, 6) AS value FROM events""")
def sink_log_topic(spark, sf):
    """Keyed messages written as files, replayed as a stream, and parsed again."""
    path = scratch_dir(spark, "topic")
    rows = table(spark, sf, "events").select("event_id", "event_type", r6("value"))
    R.write_log_topic(R.log_messages(rows, "event_id"), path)
    stream = R.read_log_topic(spark, path, schema="key string, value string")
    back = R.run_to_files(stream, "topic-replay")
    parsed = F.from_json("value", "event_id bigint, event_type string, value double")
    return back.select("key", parsed.alias("v")).select("key", "v.*")


@query("src_log_topic", with_views("log", """SELECT "partition", "offset", value FROM log"""))
def src_log_topic(spark, sf):
    """The log written as files of the envelope (partition, offset, value) and replayed from the start."""
    path = scratch_dir(spark, "log-files")
    V.log(spark, sf).write.json(path)
    stream = R.read_log_topic(spark, path, schema="partition int, offset bigint, value string")
    return R.run_to_files(stream, "log-replay")


@query("velocity_1h", """SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
  AS velocity_1h FROM events""")
def velocity_1h(spark, sf):
    return trailing_count(table(spark, sf, "events"), "user_id", "ts", 3600).select("event_id", "velocity_1h")


@query("amount_deviation", """SELECT event_id, round(CASE WHEN stddev_pop(value) OVER w > 0 THEN least(3.0, abs(value - avg(value) OVER w)/stddev_pop(value) OVER w) ELSE 0.0 END, 6)::double
  AS amount_deviation FROM events WINDOW w AS (PARTITION BY user_id)""")
def amount_deviation(spark, sf):
    return deviation_from_mean(table(spark, sf, "events"), "user_id", "value").select("event_id", "amount_deviation")
