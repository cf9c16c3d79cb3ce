"""Streaming forms of counting, joining, deduplication and scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_dir

# Two event layouts share one envelope; the payload struct holds the fields of both.
ENVELOPE = (
    "metadata struct<event_id:string,source_system:string,ingestion_ts:string,schema_version:string>, "
    "payload struct<order_id:string,order_status:string,sku:string,quantity:int,decision:string,amount:bigint,fraud_score:int>"
)


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A table of the data folder, one file or a folder of files, as a stream."""
    base = f"{sf_dir.rstrip('/')}/{name}"
    schema = spark.read.parquet(f"{base}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A stream takes the path of a single file only as a pattern; this one matches nothing but the name itself.
    return reader.parquet(f"{base}.parque[t]")


def read_log_topic(
    spark: SparkSession, source: str, servers: str | None = None, schema: str | None = None, per_batch: int | None = None,
) -> DataFrame:
    """Bounded replay of a log from its earliest offset: (partition, offset, key, value).

    ``per_batch`` bounds a micro-batch, in offsets of a topic or in files. With ``servers`` the source is a Kafka topic, which needs the connector on the classpath; otherwise it is a folder
    of files with the same columns.
    """
    if servers:
        rows = (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", source)
            .option("startingOffsets", "earliest")
        )
        rows = (rows.option("maxOffsetsPerTrigger", per_batch) if per_batch else rows).load()
        return rows.select("partition", "offset", "key", "value")
    files = spark.readStream.schema(schema or "partition int, offset bigint, key string, value string")
    return (files.option("maxFilesPerTrigger", per_batch) if per_batch else files).json(source)


def log_messages(df: DataFrame, key: str, value: Column | None = None) -> DataFrame:
    """Keyed JSON messages of a frame: (key, value)."""
    return df.select(F.col(key).cast("string").alias("key"), (F.to_json(F.struct("*")) if value is None else value).alias("value"))


def write_log_topic(messages: DataFrame, target: str, servers: str | None = None) -> None:
    """Messages to a Kafka topic, or to files with the same columns; equal keys stay in one partition."""
    if servers:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        messages.repartition("key").write.mode("append").json(target)


def flatten_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    return df.select(F.from_json(value, ENVELOPE).alias("e")).select("e.metadata.*", "e.payload.*")


def run_to_files(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over what is there now and return what it wrote."""
    spark = stream.sparkSession
    path, checkpoint = scratch_dir(spark, purpose), scratch_dir(spark, f"{purpose}-checkpoint")
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Run an update stream over what is there now; the result is the last state of every key.

    If a batch gives a key several states, the one with the largest values counts.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch_dir(spark, purpose), scratch_dir(spark, f"{purpose}-checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(path)

    stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    states = spark.read.parquet(path)
    rest = [c for c in stream.columns if c not in keys]
    last = states.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("batch_id", *rest)).alias("s"))
    return last.select(*keys, "s.*")


def windowed_velocity(events: DataFrame, ts: str, user: str, late: str = "2 hours", window: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Events per user in sliding event-time windows."""
    rows = events.select(F.col(ts).cast("timestamp").alias("ts"), F.col(user).alias("user_id"))
    counts = rows.withWatermark("ts", late).groupBy(F.window("ts", window, slide).alias("w"), "user_id").agg(
        F.count("*").alias("velocity")
    )
    return counts.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "user_id", "velocity"
    )


def drop_replays(log: DataFrame, ts: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Every log position once, as long as a replay comes within the watermark delay."""
    return log.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def pair_streams(left: DataFrame, right: DataFrame, key: str, ts: str, within: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Inner join of two event streams on a key and a time bound; state older than both delays is dropped."""
    a = left.select(F.col(key).alias(key), F.col(ts).alias("left_ts"), F.struct("*").alias("left_event")).withWatermark("left_ts", late)
    b = right.select(F.col(key).alias("_key"), F.col(ts).alias("right_ts"), F.struct("*").alias("right_event")).withWatermark("right_ts", late)
    gap = F.expr(f"INTERVAL {within}")
    on = (F.col(key) == F.col("_key")) & (F.col("right_ts") >= F.col("left_ts") - gap) & (F.col("right_ts") <= F.col("left_ts") + gap)
    return a.join(b, on).drop("_key")


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A scoring function of batch frames applied to a stream; it may only use row-wise operations."""
    return score(stream)
