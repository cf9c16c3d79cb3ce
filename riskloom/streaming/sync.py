"""Copying a partitioned log into tables: dead letters, gaps, replays and the audit loop."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from riskloom.operators.joins import insert_ignore
from riskloom.session import exists, materialize, staged
from riskloom.streaming.flows import write_log_topic

KEY = ["partition", "offset"]
TABLE_SCHEMA = "partition int, offset bigint, payload string, batch_id bigint, offset_range bigint"

#: Offsets of a partition that share a folder of a table.
OFFSETS_PER_RANGE = 1_000_000

# Fixed value: number of missing rows from which a table counts as lagging.
LAG_THRESHOLD = 5


@F.pandas_udf(StringType())
def decoder_error(text: pd.Series) -> pd.Series:
    """Why the standard decoder takes a text for no JSON document; null for null and for a document."""

    def check(t):
        if t is None:
            return None
        try:
            json.loads(t)
            return None
        except Exception as e:  # whatever the decoder fails with (deep nesting is no ValueError), the row is dead
            return str(e) or type(e).__name__

    return text.map(check)


def surely_json(text: Column) -> Column:
    """Whether Spark's own parser proves a text to be one JSON document. False proves nothing.

    The parser reads one value and ignores what follows. As the only element of an array, a text may be followed by a
    comma and a value; as the only member of an object, by a comma and a name with its value. No text is both, so what
    is accepted in both places has nothing behind its value. Repeated names and NaN, which the standard decoder allows,
    are not accepted.
    """
    def accepted(*parts: Column) -> Column:
        return F.try_parse_json(F.concat(*parts)).isNotNull()

    return F.coalesce(
        accepted(F.lit("["), text, F.lit("]")) & accepted(F.lit('{"a":'), text, F.lit("}")), F.lit(False)
    )


def doubtful(text: Column) -> Column:
    """The texts that only the standard decoder can judge, null for the others."""
    return F.when(~surely_json(text), text)


def json_error(text: Column) -> Column:
    """Why a text is no JSON document, null when it is one.

    In two stages: Spark's strict parser clears ordinary documents inside the JVM, and only the texts that it rejects
    reach the Python decoder, whose verdict counts.
    """
    return F.when(text.isNull(), "payload is missing").otherwise(decoder_error(doubtful(text)))


def decode_strict(value: Column) -> Column:
    """UTF-8 text of a binary column, null where the bytes are no valid UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def decode_replace(value: Column) -> Column:
    """UTF-8 text with the replacement character for every invalid sequence."""
    return F.make_valid_utf8(value.cast("string"))


def checked(log: DataFrame) -> DataFrame:
    """Log rows (partition, offset, value) with decoded text and the reason why a row is dead."""
    if dict(log.dtypes)["value"] == "binary":
        strict, loose = decode_strict(F.col("value")), decode_replace(F.col("value"))
        rows = log.select(*KEY, strict.alias("_strict"), loose.alias("_text"))
        error = F.when(F.col("_strict").isNull() & F.col("_text").isNotNull(), "payload is no valid UTF-8").otherwise(
            json_error(F.col("_strict"))
        )
        return rows.select(*KEY, F.col("_text").alias("value"), error.alias("error"))
    return log.select(*KEY, "value", json_error(F.col("value")).alias("error"))


def main_rows(rows: DataFrame) -> DataFrame:
    return rows.filter("error IS NULL").select(*KEY, F.col("value").alias("payload"))


def dead_rows(rows: DataFrame) -> DataFrame:
    report = F.to_json(F.struct(F.col("error").alias("error_message"), F.col("value").alias("original_payload")))
    return rows.filter("error IS NOT NULL").select(*KEY, report.alias("payload"))


def dlq_split(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the main table and rows for the dead-letter table; each payload is decoded once for both."""
    rows = materialize(checked(log), "checked")
    return main_rows(rows), dead_rows(rows)


def high_watermarks(log: DataFrame) -> DataFrame:
    """End offset per partition: one above the largest offset."""
    return log.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def watermark_summary(log: DataFrame) -> DataFrame:
    """Sum of the end offsets (for counting rows) and the largest offset (for comparing maxima), 0 for an empty log."""
    ends = high_watermarks(log)
    return ends.agg(
        F.coalesce(F.sum("end_offset"), F.lit(0)).alias("total_end"),
        F.coalesce(F.max(F.col("end_offset") - 1), F.lit(0)).alias("max_offset"),
    )


def together(tables: tuple[DataFrame, ...], *columns: str) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])


def max_offset(*tables: DataFrame) -> DataFrame:
    """Largest offset over the tables that a log is copied into, 0 when all are empty."""
    return together(tables, "offset").agg(F.coalesce(F.max("offset"), F.lit(0)).alias("max_offset"))


def sync_gap(log: DataFrame, *tables: DataFrame, threshold: int = LAG_THRESHOLD) -> DataFrame:
    """Missing rows per partition; rows of all tables, dead letters too, count as arrived."""
    there = together(tables, "partition").groupBy("partition").agg(F.count("*").alias("synced"))
    gap = high_watermarks(log).join(there, "partition", "left").withColumn("synced", F.coalesce("synced", F.lit(0)))
    return gap.withColumn("gap", F.col("end_offset") - F.col("synced")).withColumn("lagging", F.col("gap") >= threshold)


def total_gap(gaps: DataFrame, threshold: int = LAG_THRESHOLD) -> DataFrame:
    total = F.coalesce(F.sum("gap"), F.lit(0))
    return gaps.agg(total.alias("gap"), (total >= threshold).alias("lagging"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(path)


def ensure_tables(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        spark.createDataFrame([], TABLE_SCHEMA).write.mode("ignore").partitionBy("offset_range").parquet(path)


def offset_range(offset: Column) -> Column:
    return F.floor(offset / F.lit(OFFSETS_PER_RANGE)).cast("bigint")


def append_new(rows: DataFrame, stored: DataFrame, path: str, batch_id: int) -> None:
    """Append the rows (partition, offset, payload) whose positions the stored rows do not hold."""
    new = insert_ignore(stored.select(*KEY, "payload"), rows, KEY)
    new.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "offset_range": offset_range(F.col("offset"))}).write.mode(
        "append"
    ).partitionBy("offset_range").parquet(path)


def compact(spark: SparkSession, path: str, target: str) -> DataFrame:
    """A copy of a table with one sorted run of files per range of offsets, whatever batches wrote it."""
    rows = read_table(spark, path)
    rows.repartition("offset_range", "partition").sortWithinPartitions("offset_range", "partition", "offset").write.partitionBy(
        "offset_range"
    ).parquet(target)
    return read_table(spark, target)


def dead_messages(rows: DataFrame) -> DataFrame:
    """Dead letters as keyed messages; the key is the position in the log."""
    return rows.select(F.concat_ws("-", *KEY).alias("key"), F.col("payload").alias("value"), *KEY)


def publish_new(messages: DataFrame, topic: str, servers: str | None) -> None:
    """Write the messages whose keys the topic does not hold yet.

    A topic takes what it is sent, so a repeated batch has to look: the topic itself, and not the dead-letter table, says
    what it holds, as a batch may have ended between the two.
    """
    spark = messages.sparkSession
    held = topic_messages(spark, topic, servers)
    new = messages.dropDuplicates(["key"]) if held is None else messages.dropDuplicates(["key"]).join(
        held.select("key"), "key", "left_anti"
    )
    write_log_topic(new.select("key", "value"), topic, servers)


def topic_messages(spark: SparkSession, topic: str, servers: str | None = None) -> DataFrame | None:
    """(key, value) of all messages of a topic, None if a topic of files does not exist yet."""
    if servers:
        rows = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        return rows.option("startingOffsets", "earliest").load().selectExpr("CAST(key AS STRING)", "CAST(value AS STRING)")
    return spark.read.schema("key string, value string").json(topic) if exists(spark, topic) else None


def sync_batch(
    main_path: str, dead_path: str, dead_topic: str | None = None, servers: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch: rows to the main table, dead letters to their table and, if named, to their topic.

    Tables are laid out by ranges of offsets. A batch reads what the ranges that it touches hold, a partition filter, and
    appends the positions that are missing. Each sink is compared with its own content, so after a failure at any point
    the repeated batch adds what was lost and nothing twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged(checked(batch).withColumn("offset_range", offset_range(F.col("offset"))), "batch") as rows:
            bounds = rows.agg(F.min("offset_range").alias("low"), F.max("offset_range").alias("high")).first()
            if bounds.low is None:
                return
            touched = F.col("offset_range").between(bounds.low, bounds.high)
            dead = dead_rows(rows)
            for path, part in ((main_path, main_rows(rows)), (dead_path, dead)):
                append_new(part, read_table(spark, path).filter(touched), path, batch_id)
            if dead_topic:
                publish_new(dead_messages(dead), dead_topic, servers)

    return write


def start_sync(
    log: DataFrame, main_path: str, dead_path: str, checkpoint: str, dead_topic: str | None = None,
    servers: str | None = None,
) -> StreamingQuery:
    """Copy what a streaming log holds now into the two tables and, if named, the dead-letter topic.

    The size of a micro-batch is the source's matter: maxFilesPerTrigger of files, maxOffsetsPerTrigger of a topic.
    """
    ensure_tables(log.sparkSession, main_path, dead_path)
    return (
        log.writeStream.foreachBatch(sync_batch(main_path, dead_path, dead_topic, servers))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def audit(
    open_log: Callable[[], DataFrame], bounded_log: DataFrame, main_path: str, dead_path: str, checkpoint: str,
    max_rounds: int = 5,
) -> list[tuple[int, int, int, str]]:
    """Sync rounds until nothing new was found or no gap is left: (round, rows written, gap, state) per round."""
    spark = bounded_log.sparkSession
    ensure_tables(spark, main_path, dead_path)
    report = []
    for n in range(1, max_rounds + 1):
        sync = start_sync(open_log(), main_path, dead_path, checkpoint)
        sync.awaitTermination()
        written = sum(p["numInputRows"] for p in sync.recentProgress)
        gaps = sync_gap(bounded_log, read_table(spark, main_path), read_table(spark, dead_path))
        gap = total_gap(gaps).first().gap
        done = written == 0 or gap <= 0
        report.append((n, written, gap, "Synced" if done else "Retrying"))
        if done:
            return report
    raise RuntimeError(f"{gap} rows are still missing after {max_rounds} rounds: {report}")
