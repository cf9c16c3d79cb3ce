"""Column scaling: parameters are fitted in one aggregation and applied as literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-8

Params = dict[str, tuple[float, float]]


def fit_minmax(df: DataFrame, cols: list[str]) -> Params:
    row = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in cols for f in (F.min, F.max)]).first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in cols}


def apply_minmax(df: DataFrame, params: Params, constant: str = "zero") -> DataFrame:
    """(x - min) / (max - min). Constant columns: 'zero' gives 0, 'keep' leaves them, 'eps' adds 1e-8 to the range."""
    out = {}
    for c, (lo, hi) in params.items():
        x = F.col(c)
        if lo is None:
            continue
        if constant == "eps":
            out[c] = (x - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + F.lit(EPS))
        elif hi > lo:
            out[c] = (x - F.lit(lo)) / (F.lit(hi) - F.lit(lo))
        elif constant == "zero":
            out[c] = F.lit(0.0)
    return df.withColumns(out) if out else df


def fit_zscore(df: DataFrame, cols: list[str]) -> Params:
    row = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols], *[F.stddev_pop(c).alias(f"std_{c}") for c in cols]
    ).first()
    return {c: (row[f"mean_{c}"], row[f"std_{c}"] + EPS) for c in cols if row[f"mean_{c}"] is not None}


def apply_zscore(df: DataFrame, params: Params, extra_eps: float = 0.0) -> DataFrame:
    """(x - mean) / std with stored parameters; ``extra_eps`` is added to the stored std once more."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s + extra_eps) for c, (m, s) in params.items()})
