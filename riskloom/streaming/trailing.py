"""Trailing counts per event on a stream, with late rows, by keyed state and event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MICROS = 1_000_000
# Groups of keys per block of time: a call per group and batch, however many keys there are.
GROUPS = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TrailingCounter(StatefulProcessor):
    """State of a group of keys in one block of time: per batch one packed frame of the rows that it brought.

    New rows change the counts of their key's rows up to ``span`` after them, so these are given out again. A timer clears
    the state when the watermark has passed the block, as no row of it is accepted any more.
    """

    def __init__(self, span: int, block: int):
        self.span, self.block = span, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("rows", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)[["user", "t", "id", "own"]]
        before = [unpacked(row[0]) for row in self.held.get()]
        if not before:
            self.handle.registerTimer((int(key[1]) + 1) * self.block // 1000)
        self.held.appendValue((packed(new),))
        every = pd.concat([*before, new], ignore_index=True)
        # All keys on one line, each further from the next than the span.
        code, t = pd.factorize(every["user"], use_na_sentinel=False)[0], every["t"].to_numpy(dtype=np.int64)
        line = code.astype(np.int64) * (t.max() - t.min() + self.span + 1) + (t - t.min())
        changed, order = np.sort(line[len(line) - len(new):]), np.argsort(line, kind="stable")
        every, line = every.take(order), line[order]
        # The last new row at or before each row: is it within the span?
        last = np.searchsorted(changed, line, side="right") - 1
        touched = (last >= 0) & (line - changed[np.maximum(last, 0)] <= self.span) & every["own"].to_numpy(dtype=bool)
        at, given = line[touched], every[touched]
        count = np.searchsorted(line, at, side="right") - np.searchsorted(line, at - self.span, side="left")
        yield pd.DataFrame({"id": given["id"], "user": given["user"], "t": given["t"], "n": count})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        yield pd.DataFrame({"id": [], "user": [], "t": [], "n": []})

    def close(self) -> None:
        pass


def packed(rows: pd.DataFrame) -> bytes:
    batch, sink = pa.RecordBatch.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(rows: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(rows)).read_pandas()


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def trailing_stream(
    events: DataFrame, key: str, ts: str, id_column: str, seconds: int = 3600, late: str = "2 hours",
    block_seconds: int = 86_400, out: str = "velocity_1h", groups: int = GROUPS,
) -> DataFrame:
    """An update stream of (id, key, ts, count): rows of the same key in the ``seconds`` up to each event's own time.

    Events count in event-time order, whatever batch they come in, as long as they are not later than the watermark:
    when a late row arrives, the counts that it raises are given out again. Counts only grow, so the largest one of an id
    is its last. The state is kept per group of keys (by hash) and block of time: keys with a few rows share a call, the
    last ``seconds`` of a block are copied to the next one, so a busy key is spread over as many calls as it has blocks,
    and old blocks are dropped whole. Rows without time or key, which no state could be kept for, are left out.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # timers need it
    span, block = seconds * MICROS, max(seconds, block_seconds) * MICROS
    at = F.col("t")
    rows = (
        events.select(F.col(ts).cast("timestamp").alias("ts"), F.col(key).alias("user"), F.col(id_column).alias("id"))
        .withWatermark("ts", late).filter("ts IS NOT NULL AND user IS NOT NULL").withColumn("t", micros(F.col("ts")))
    )
    own, following = F.floor(at / F.lit(block)), F.floor((at + F.lit(span)) / F.lit(block))
    placed = rows.withColumn(
        "block", F.explode(F.when(own == following, F.array(own)).otherwise(F.array(own, following)))
    ).withColumn("own", F.col("block") == own)
    # Texts travel as bytes: the state protocol does not take pandas' text columns in every version.
    types = dict(rows.dtypes)
    wire = {c: "binary" if types[c] == "string" else types[c] for c in ("id", "user")}
    placed = placed.withColumns({c: F.col(c).cast(t) for c, t in wire.items()})
    placed = placed.withColumn("group", F.pmod(F.xxhash64("user"), F.lit(groups)))
    counted = placed.groupBy("group", "block").transformWithStateInPandas(
        TrailingCounter(span, block),
        outputStructType=f"id {wire['id']}, user {wire['user']}, t bigint, n bigint", outputMode="Update",
        timeMode="EventTime",
    )
    return counted.select(
        F.col("id").cast(types["id"]).alias(id_column), F.col("user").cast(types["user"]).alias(key),
        F.timestamp_micros("t").cast("timestamp_ntz").alias(ts), F.col("n").alias(out),
    )
