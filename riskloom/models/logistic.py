"""Class-weighted logistic regression by full-batch gradient steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import clip
from riskloom.operators.scaling import Params, apply_zscore, fit_zscore
from riskloom.session import materialize

LIMIT = 500.0


@dataclass
class Logistic:
    features: list[str]
    weights: list[float]
    bias: float
    scaling: Params
    class_weight: float

    def probability(self) -> Column:
        """Score on z-scored inputs."""
        return sigmoid(linear(self.features, self.weights, self.bias))

    def apply(self, df: DataFrame, out: str = "score") -> DataFrame:
        scaled = {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.scaling.items()}
        z = F.lit(self.bias)
        for c, w in zip(self.features, self.weights):
            z = z + F.lit(w) * scaled[c]
        return df.withColumn(out, sigmoid(z))


def linear(features: Sequence[str], weights: Sequence[float], bias: float) -> Column:
    z = F.lit(float(bias))
    for c, w in zip(features, weights):
        z = z + F.lit(float(w)) * F.col(c)
    return z


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(z, -LIMIT, LIMIT)))


def train_logistic(df: DataFrame, features: Sequence[str], label: str, steps: int = 50, rate: float = 0.001) -> Logistic:
    """Each step is one aggregation over the scaled rows.

    The rows are a stage table, kept in memory or on disk meanwhile: its partitions follow its size, and a lost
    executor costs a read of the table and not the pipeline behind it.
    """
    rows = materialize(df.select(*features, F.col(label).cast("double").alias("_y")), "logistic-rows")
    params = fit_zscore(rows, list(features))
    rows = apply_zscore(rows, params).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        share = rows.agg(F.avg("_y")).first()[0]
        heavy = (1.0 - share) / share if share else 1.0  # without positives no row carries the weight
        # SQL text: one call builds a step, where column objects would take dozens of calls to the JVM.
        cols = [f"`{c}`" for c in features]
        error = f"(1D / (1D + exp(-greatest({-LIMIT}D, least({LIMIT}D, _z)))) - _y) * CASE WHEN _y = 1 THEN {heavy!r}D ELSE 1D END"
        slopes = [f"avg(_e * {c})" for c in cols]
        w, b = [0.0] * len(cols), 0.0
        for _ in range(steps):
            z = " + ".join([f"{b!r}D", *[f"{x!r}D * {c}" for x, c in zip(w, cols)]])
            g = rows.selectExpr("_y", f"{z} AS _z", *cols).selectExpr(f"{error} AS _e", *cols).selectExpr("avg(_e)", *slopes).first()
            b -= rate * g[0]
            w = [x - rate * d for x, d in zip(w, g[1:])]
    finally:
        rows.unpersist()
    return Logistic(list(features), w, b, params, heavy)
