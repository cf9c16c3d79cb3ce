"""How many tasks run in each minute, per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

OTHERS = "others"

#: Minutes of a range of the time axis.
RANGE = 1440


def _minutes(spans: DataFrame) -> DataFrame:
    """Spans as first and last minute; open spans and those that end before their first minute drop out."""
    return (
        spans.filter("start_date IS NOT NULL AND end_date IS NOT NULL")
        .select("dag_id", F.date_trunc("minute", "start_date").alias("first"), F.col("end_date").cast("timestamp").alias("e"))
        .filter("e >= first").select("dag_id", "first", F.date_trunc("minute", "e").alias("last"))
    )


def _points(first: str = "first", last: str = "last"):
    return (F.unix_seconds(last) - F.unix_seconds(first)) / F.lit(60) + 1


def dag_points(spans: DataFrame) -> DataFrame:
    return _minutes(spans).groupBy("dag_id").agg(F.sum(_points()).cast("bigint").alias("points"))


def top_members(totals: DataFrame, key: str, weight: str, n: int = 10) -> DataFrame:
    """The n heaviest keys; equal weights go by key."""
    return totals.orderBy(F.col(weight).desc(), F.col(key).asc()).limit(n)


def with_group(df: DataFrame, key: str, top: DataFrame, out: str = "dag_group") -> DataFrame:
    """Keys outside the top list become 'others'. The list holds at most n rows, so it is broadcast."""
    marks = F.broadcast(top.select(F.col(key).alias("_top")))
    return df.join(marks, F.col(key) == F.col("_top"), "left").withColumn(
        out, F.when(F.col("_top").isNotNull(), F.col(key)).otherwise(OTHERS)
    ).drop("_top")


def by_minute(spans: DataFrame, top: int = 10) -> DataFrame:
    """(minute, dag_group, load) for every minute in which a group has running tasks.

    Each span adds +1 at its first minute and -1 after its last one. These changes are summed per group and minute,
    so the running total sees one row per change and not one per task and minute; a load is then spread over the
    minutes up to the next change. The time axis is cut into ranges of RANGE minutes: a window holds one range of one
    group, and starts with the load that the group brings into the range (see ``carried``).
    """
    minutes = _minutes(spans)
    members = top_members(dag_points(spans), "dag_id", "points", top)
    grouped = with_group(minutes, "dag_id", members)
    change = F.inline(F.array(
        F.struct(_minute_number("first").alias("at"), F.lit(1).cast("bigint").alias("d")),
        F.struct((_minute_number("last") + 1).alias("at"), F.lit(-1).cast("bigint").alias("d")),
    ))
    changes = grouped.select("dag_group", change).groupBy("dag_group", "at").agg(F.sum("d").alias("d"))
    deltas = materialize(changes.withColumn("range", F.floor(F.col("at") / F.lit(RANGE))), "changes")
    points = deltas.unionByName(carried(deltas)).groupBy("dag_group", "range", "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("dag_group", "range").orderBy("at")
    loads = points.select(
        "dag_group", "at", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("load"),
        F.coalesce(F.lead("at").over(w), (F.col("range") + 1) * RANGE).alias("next"),
    ).filter("load > 0")
    spread = loads.select(F.explode(F.sequence("at", F.col("next") - 1)).alias("m"), "dag_group", "load")
    return spread.select(F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz").alias("minute"), "dag_group", "load")


def _minute_number(column: str) -> Column:
    return F.expr(f"unix_seconds({column}) div 60")


def carried(deltas: DataFrame) -> DataFrame:
    """The load with which a group enters a range, as a change at the range's first minute.

    Only sums per group and range are put in order, and a load that lasts over ranges without changes enters each of
    them, so a span of any length is work of many ranges.
    """
    w = Window.partitionBy("dag_group").orderBy("range")
    sums = deltas.groupBy("dag_group", "range").agg(F.sum("d").alias("d")).select(
        "dag_group", F.col("range").alias("from"), F.lead("range").over(w).alias("to"),
        F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("d"),
    ).filter("d > 0")  # after its last change a group has no load
    entered = sums.select("dag_group", "d", F.explode(F.sequence(F.col("from") + 1, F.col("to"))).alias("range"))
    return entered.select("dag_group", (F.col("range") * RANGE).alias("at"), "d", "range")


def pivot_minutes(loads: DataFrame) -> DataFrame:
    """One column per group, heaviest group first, 0 where a group is idle."""
    totals = loads.groupBy("dag_group").agg(F.sum("load").alias("t")).orderBy(F.col("t").desc(), "dag_group")
    groups = [r[0] for r in totals.collect()]  # at most the top members and 'others'
    return loads.groupBy("minute").pivot("dag_group", groups).agg(F.sum("load")).na.fill(0)


def peak(loads: DataFrame, limit: int = 16) -> DataFrame:
    """Highest total load, the first minute it occurs in, and whether it exceeds the limit."""
    total = loads.groupBy("minute").agg(F.sum("load").alias("peak_load"))
    return total.orderBy(F.col("peak_load").desc(), "minute").limit(1).select(
        "peak_load", F.col("minute").alias("peak_at"), (F.col("peak_load") > limit).alias("is_over_limit")
    )


def contribution(loads: DataFrame) -> DataFrame:
    """Share of all task minutes per group in percent."""
    per = loads.groupBy("dag_group").agg(F.sum("load").alias("points"))
    return per.withColumn(
        "percent", F.lit(100.0) * F.col("points") / F.sum("points").over(Window.partitionBy(F.lit(0)))
    )
