"""Key-based table updates and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` to append: one per key, only keys the target lacks.

    Copies of a key are reduced by an aggregation, so many copies never meet in one task.
    """
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    return first.join(target.select(*keys), list(keys), "left_anti").select(*new.columns)


def upsert_by_key(target: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Target after insert-or-replace: per key the row with the highest version; new rows win over stored ones."""
    rows = target.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in target.columns if c != key]
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("_new", version)).alias("_r"))
    return latest.select(key, "_r.*").select(*target.columns)


def pair_sources(events: DataFrame, key: str, source: str, left: str, right: str) -> DataFrame:
    """One row per key that both source systems reported: (key, left event, right event).

    Both sides meet in one aggregation by key, so there is one shuffle and copies of an event collapse before it.
    """
    event = F.struct(*[c for c in events.columns if c not in (key, source)])
    pairs = events.groupBy(key).agg(
        F.min(F.when(F.col(source) == left, event)).alias("left_event"),
        F.min(F.when(F.col(source) == right, event)).alias("right_event"),
    )
    return pairs.filter("left_event IS NOT NULL AND right_event IS NOT NULL")


def agreement(decisions: Sequence[str], failed: str = "ERROR") -> Column:
    """YES when the decisions that did not fail are one and the same."""
    valid = F.array_distinct(F.filter(F.array(*[F.col(d) for d in decisions]), lambda x: x != failed))
    return F.when(F.size(valid) == 1, "YES").otherwise("NO")


def last_before(
    rows: DataFrame, events: DataFrame, key: str, at: str, event_at: str, tie: str, out: str = "last",
    slice_seconds: int = 86_400,
) -> DataFrame:
    """As-of join: each row with the last event of its key at or before its time, as a struct ``out`` (null if none).

    Equal event times are decided by ``tie``, the larger one is later. The time axis is cut into slices: a window runs
    per (key, slice) over the rows and events of the slice, and what a key brings into a slice comes from the last event
    of each earlier slice, one row per key and slice. So a busy key is spread over its slices. Rows without key or time
    have no last event; events without key or time are left out.
    """
    def slice_of(column: str) -> Column:
        return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / F.lit(slice_seconds * 1_000_000))

    marked = rows.withColumns({"_slice": slice_of(at), "_at": F.col(at), "_tie": F.lit(None).cast(dict(events.dtypes)[tie])})
    known = events.filter(F.col(key).isNotNull() & F.col(event_at).isNotNull()).select(
        F.col(key), F.col(event_at).alias("_at"), F.col(tie).alias("_tie"), slice_of(event_at).alias("_slice"),
        F.struct(*events.columns).alias("_event"),
    )
    ends = known.groupBy(key, "_slice").agg(F.max_by("_event", F.struct("_at", "_tie")).alias("_end"))
    met = marked.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, "_slice").distinct()
    past = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    brought = (
        met.join(ends, [key, "_slice"], "full").withColumn("_brought", F.last("_end", ignorenulls=True).over(past))
        .select(F.col(key).alias("_key"), F.col("_slice").alias("_in"), "_brought")
    )
    both = marked.withColumn("_row", F.lit(1)).unionByName(known.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy(key, "_slice").orderBy("_at", "_row", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_inside", F.last("_event", ignorenulls=True).over(upto)).filter("_row = 1")
    joined = inside.join(brought, (F.col(key) == F.col("_key")) & (F.col("_slice") == F.col("_in")), "left")
    has_both = F.col(key).isNotNull() & F.col(at).isNotNull()
    return joined.withColumn(out, F.when(has_both, F.coalesce("_inside", "_brought"))).select(*rows.columns, out)
