"""Roles of columns in wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def target_column(df: DataFrame, names: tuple[str, ...] = ("is_fraud", "isFraud")) -> tuple[str, list[str]]:
    """The label column, by name or else the last one, and the others in order as features."""
    target = next((c for c in names if c in df.columns), df.columns[-1])
    return target, [c for c in df.columns if c != target]


def assemble(df: DataFrame, features: list[str], target: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Features as one array ``x`` and the label as double ``y``; missing features are 0."""
    cells = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    return df.select(*keep, F.array(*cells).alias("x"), F.col(target).cast("double").alias("y"))
