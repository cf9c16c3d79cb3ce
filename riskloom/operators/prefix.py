"""Running totals over a global order, computed in parallel per value range."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize, shuffle_width


def range_bounds(df: DataFrame, value: str, parts: int) -> list[float]:
    """At most ``parts - 1`` distinct inner bounds that cut the values into ranges of similar size."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    numbers = F.when(~F.isnan(value), F.col(value))
    marks = df.agg(F.percentile_approx(numbers, shares, max(1000, 10 * parts))).first()[0] or []
    return sorted({float(m) for m in marks})


def with_range(df: DataFrame, value: str, bounds: list[float], out: str = "_range") -> DataFrame:
    if not bounds:
        return df.withColumn(out, F.lit(0))
    splits = [-float("inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep")
    return cut.transform(df).withColumn(out, F.col(out).cast("int"))


def value_sums(df: DataFrame, value: str, sums: list[str], by: list[str]) -> DataFrame:
    """Sums per distinct value as a stage table."""
    return materialize(df.groupBy(*by, value).agg(*[F.sum(s).alias(s) for s in sums]), "value-sums")


def running_totals(
    df: DataFrame, value: str, sums: list[str], by: list[str] | None = None, descending: bool = False,
    parts: int | None = None, summed: bool = False,
) -> DataFrame:
    """One row per distinct value with its own sums (``<s>``) and the sums of all values before it (``<s>_before``).

    Rows are first summed per distinct value (map-side) into a stage table, unless the frame is ``summed`` already. The
    value axis is cut into ranges; a window runs inside each range, and the totals of earlier ranges, a frame of at
    most ``parts`` rows per group, are added by an equi-join. No task sees more than one range.
    """
    by = by or []
    per_value = df if summed else value_sums(df, value, sums, by)
    bounds = range_bounds(per_value, value, parts or shuffle_width(df.sparkSession))
    ranged = with_range(per_value, value, bounds)

    def order(c: str):
        return F.col(c).desc() if descending else F.col(c).asc()

    inside = Window.partitionBy(*by, "_range").orderBy(order(value)).rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"_k{i}" for i in range(len(by))]
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order("_r")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = ranged.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col("_range").alias("_r")).agg(
        *[F.sum(s).alias(f"_t_{s}") for s in sums]
    )
    offsets = totals.select(
        *keys, "_r", *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    local = ranged.select(
        *by, value, "_range", *sums, *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_b_{s}") for s in sums]
    )
    on = F.col("_range") == F.col("_r")
    for i, k in enumerate(by):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(offsets, on).select(
        *by, value, *sums, *[(F.col(f"_b_{s}") + F.col(f"_o_{s}")).alias(f"{s}_before") for s in sums]
    )
