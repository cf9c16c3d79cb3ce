"""Per-user behaviour features: trailing counts and deviation from the own mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import cap as at_most

MICROS = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def trailing_count(
    df: DataFrame, key: str, ts: str, seconds: int, out: str = "velocity_1h", slices: int = 720
) -> DataFrame:
    """Rows of the same key in the ``seconds`` up to and including the row's own time.

    A window partitioned by key alone would put all rows of a busy key into one task. Here the time
    axis is cut into slices of ``seconds / slices`` and the window runs per (key, slice). A trailing
    interval is then: the own slice up to now, the whole slices in between (taken from pre-aggregated
    totals), and the tail of the one slice in which the interval starts. Only that tail is copied.

    The slices in between always lie in the own block of ``lag`` slices and the one before, so their sum needs
    no running total over the key's whole past: see ``sums_between``.
    """
    span = seconds * MICROS
    width = span // slices
    lag = -(-span // width)
    rows = df.withColumn("_t", micros(F.col(ts))).withColumn("_s", F.floor(F.col("_t") / F.lit(width)))
    totals = sums_between(rows.groupBy(key, "_s").agg(F.count(F.lit(1)).alias("_n")), key, lag)
    own = rows.withColumn("_own", F.lit(1))
    tail = rows.select(
        key, (F.col("_t") + F.lit(span)).alias("_t"), (F.col("_s") + F.lit(lag)).alias("_s"), F.lit(0).alias("_own")
    )
    part = Window.partitionBy(key, "_s")
    upto = part.orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = part.orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    copied = F.lit(1) - F.col("_own")
    counted = (
        own.unionByName(tail, allowMissingColumns=True)
        .withColumn("_upto", F.sum("_own").over(upto))
        .withColumn("_tail", F.sum(copied).over(part) - F.coalesce(F.sum(copied).over(before), F.lit(0)))
        .filter("_own = 1")
    )
    joined = counted.join(totals, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_s") == F.col("_slice")), "left")
    total = F.col("_upto") + F.col("_tail") + F.coalesce(F.col("_between"), F.lit(0))
    return joined.withColumn(out, total).select(*df.columns, out)


def sums_between(totals: DataFrame, key: str, lag: int) -> DataFrame:
    """For each (key, slice) of totals ``_n``: the sum over the ``lag - 1`` slices before it, as _key, _slice, _between.

    The time axis is cut into blocks of ``lag`` slices. What lies between is the own block's part before the slice, and
    the part of the block before that is less than ``lag`` slices back. Each total therefore counts in its own block
    from the next slice on, and a copy of it in the next block until the slice ``lag`` later. A window holds one block
    of one key, at most ``2 * lag`` rows, however long the key's history is.
    """
    placed = totals.select(
        F.col(key).alias("_key"),
        F.inline(F.array(
            F.struct(F.col("_s").alias("_slice"), F.col("_n").alias("_comes"), F.lit(0).cast("bigint").alias("_goes")),
            F.struct((F.col("_s") + lag).alias("_slice"), F.lit(0).cast("bigint").alias("_comes"), F.col("_n").alias("_goes")),
        )),
    ).withColumn("_block", F.floor(F.col("_slice") / F.lit(lag)))
    block = Window.partitionBy("_key", "_block")
    past = block.orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    reached = block.orderBy("_slice").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    between = (
        F.coalesce(F.sum("_comes").over(past), F.lit(0)) + F.sum("_goes").over(block) - F.sum("_goes").over(reached)
    )
    return placed.withColumn("_between", between).filter("_comes > 0").select("_key", "_slice", "_between")


def deviation_from_mean(
    df: DataFrame, key: str, value: str, out: str = "amount_deviation", cap: float = 3.0
) -> DataFrame:
    """|value - mean of the key| in population standard deviations, capped; 0 where there is no spread."""
    stats = df.groupBy(F.col(key).alias("_key")).agg(
        F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd")
    )
    dev = F.abs(F.col(value) - F.col("_mu")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return (
        df.join(stats, F.col(key) == F.col("_key"), "left")
        .withColumn(out, F.coalesce(F.round(at_most(dev, cap), 6), F.lit(0.0)))
        .select(*df.columns, out)
    )
