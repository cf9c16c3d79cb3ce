"""Least squares on feature pairs from distributed sums.

The rows are read once: every pair needs only sums of monomials of its two inputs (and of the label), which add up
over partitions. The small normal equations per pair are then solved from these sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.models.documents import Node, PairModel

# Monomials (power of a, power of b) of each polynomial form, in coefficient order.
FORMS: dict[int, list[tuple[int, int]]] = {
    1: [(0, 0), (1, 0), (0, 1)],
    2: [(0, 0), (1, 0), (0, 1), (1, 1)],
    3: [(0, 0), (1, 0), (0, 1), (2, 0), (0, 2)],
    4: [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2)],
    5: [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2), (2, 1)],
    6: [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2), (2, 1), (1, 2)],
}


def moment_powers(forms: Sequence[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Powers whose sums are needed alone, and those needed times the label."""
    basis = sorted({p for f in forms for p in FORMS[f]})
    plain = sorted({
        (a1 + a2, b1 + b2) for f in forms for a1, b1 in FORMS[f] for a2, b2 in FORMS[f]
    })
    return plain, basis


def moment_names(forms: Sequence[int]) -> list[str]:
    plain, basis = moment_powers(forms)
    return [f"s{a}{b}" for a, b in plain] + [f"y{a}{b}" for a, b in basis] + ["yy"]


def _monomial(a: Column, b: Column, p: int, q: int) -> Column:
    out = F.lit(1.0)
    for c, n in ((a, p), (b, q)):
        for _ in range(n):
            out = out * c
    return out


def pair_moments(df: DataFrame, features: Sequence[str], label: str, split: str, forms: Sequence[int] = (2,)) -> DataFrame:
    """Sums per split and pair of a few features: (split, a, b, s.., y.., yy), from one aggregation."""
    plain, basis = moment_powers(forms)
    y = F.col(label)
    sums: dict[str, Column] = {}

    def slot(p: int, q: int, i: str, j: str, with_y: int) -> str:
        """Name of a sum shared by all pairs that need the same monomial."""
        key = "_".join(f"{n}{e}" for n, e in ((i, p), (j, q)) if e) or "one"
        name = f"m{with_y}_{key}"
        if name not in sums:
            sums[name] = F.sum(_monomial(F.col(i), F.col(j), p, q) * (y if with_y else F.lit(1.0))).alias(name)
        return name

    pairs = list(combinations(features, 2))
    layout = [
        (i, j, [slot(p, q, i, j, 0) for p, q in plain] + [slot(p, q, i, j, 1) for p, q in basis]) for i, j in pairs
    ]
    sums["yy"] = F.sum(y * y).alias("yy")
    wide = df.groupBy(split).agg(*sums.values())
    names = moment_names(forms)
    cells = [
        F.struct(F.lit(i).alias("a"), F.lit(j).alias("b"), *[F.col(c).alias(n) for c, n in zip(cols, names)],
                 F.col("yy").alias("yy"))
        for i, j, cols in layout
    ]
    return wide.select(split, F.explode(F.array(*cells)).alias("p")).select(split, "p.*")


def wide_pair_moments(
    df: DataFrame, features: str, label: str, split: str, pairs: Sequence[tuple[int, int]], forms: Sequence[int]
) -> DataFrame:
    """The same for pairs of positions in an array column: NumPy sums per partition, added up by Spark."""
    plain, basis = moment_powers(forms)
    names = moment_names(forms)
    left, right = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    top = max(max(p) for p in plain)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for part, rows in pdf.groupby(split):
                x = np.stack(rows[features].to_numpy()).astype(np.float64)
                y = rows[label].to_numpy(dtype=np.float64)[:, None]
                a, b = [np.ones((len(rows), len(left)))], [np.ones((len(rows), len(left)))]
                for _ in range(top):
                    a.append(a[-1] * x[:, left])
                    b.append(b[-1] * x[:, right])
                sums = [(a[p] * b[q]).sum(axis=0) for p, q in plain]
                sums += [(a[p] * b[q] * y).sum(axis=0) for p, q in basis]
                sums.append(np.full(len(left), float((y * y).sum())))
                block = np.stack(sums, axis=1)
                total[part] = total[part] + block if part in total else block
        for part, block in total.items():
            out = pd.DataFrame(block, columns=names)
            out.insert(0, "b", right)
            out.insert(0, "a", left)
            out.insert(0, split, part)
            yield out

    schema = f"{split} string, a int, b int, " + ", ".join(f"{n} double" for n in names)
    parts = df.select(features, label, split).mapInPandas(partial, schema)
    return parts.groupBy(split, "a", "b").agg(*[F.sum(n).alias(n) for n in names])


def solve(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Least squares from normal equations; the shortest solution where the inputs are collinear."""
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    unit = gram / np.outer(scale, scale)
    values = np.linalg.eigvalsh(unit)
    if values[0] > 1e-12 * values[-1]:
        c = np.linalg.solve(unit, moment / scale) / scale
        residual = moment - gram @ c
        return c + np.linalg.solve(unit, residual / scale) / scale
    return np.linalg.pinv(gram, rcond=1e-12, hermitian=True) @ moment


def gram_of(row: dict[str, float], form: int) -> tuple[np.ndarray, np.ndarray]:
    powers = FORMS[form]
    gram = np.array([[row[f"s{a1 + a2}{b1 + b2}"] for a2, b2 in powers] for a1, b1 in powers])
    return gram, np.array([row[f"y{a}{b}"] for a, b in powers])


def mse_of(row: dict[str, float], form: int, c: np.ndarray) -> float:
    gram, moment = gram_of(row, form)
    return max(0.0, float(row["yy"] - 2 * c @ moment + c @ gram @ c)) / row["s00"] if row["s00"] else float("nan")


def pair_fit(moments: DataFrame, split: str, forms: Sequence[int] = (2,), train: str = "train", val: str = "val") -> DataFrame:
    """Coefficients, training and validation error per pair and form: (a, b, form, coeffs, train_mse, val_mse, n_train, rmse)."""
    names = moment_names(forms)
    key_type = dict(moments.dtypes)["a"]
    row = F.struct(*names)
    sides = moments.groupBy("a", "b").agg(
        F.max(F.when(F.col(split) == train, row)).alias("t"), F.max(F.when(F.col(split) == val, row)).alias("v")
    ).select("a", "b", *[F.col(f"t.{n}").alias(f"t_{n}") for n in names], *[F.col(f"v.{n}").alias(f"v_{n}") for n in names])
    fit_forms = list(forms)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                t, v = ({n: r[f"{side}_{n}"] for n in names} for side in "tv")
                for form in fit_forms:
                    c = solve(*gram_of(t, form))
                    out.append((r["a"], r["b"], form, c.tolist(), mse_of(t, form, c), mse_of(v, form, c), int(t["s00"])))
            yield pd.DataFrame(out, columns=["a", "b", "form", "coeffs", "train_mse", "val_mse", "n_train"])

    schema = f"a {key_type}, b {key_type}, form int, coeffs array<double>, train_mse double, val_mse double, n_train bigint"
    return sides.mapInPandas(fit, schema).withColumn("rmse", F.sqrt("val_mse"))


def topk_nodes(fits: DataFrame, k: int, *, by: str = "val_mse") -> DataFrame:
    """The k fits with the lowest error; equal errors go by pair and form."""
    return fits.orderBy(F.col(by), "a", "b", "form").limit(k)


def train_pair_model(df: DataFrame, features: Sequence[str], label: str, split: str) -> PairModel:
    """Fit all pairs, keep the two best on the validation rows, fit the master node on their outputs."""
    moments = pair_moments(df, features, label, split)
    best = topk_nodes(pair_fit(moments, split), 2).collect()  # two rows
    nodes = [Node(f"node_{r.a}_{r.b}", (r.a, r.b), list(r.coeffs)) for r in best]
    z = df.select(nodes[0].column().alias("z1"), nodes[1].column().alias("z2"), label, split)
    top = pair_fit(pair_moments(z, ["z1", "z2"], label, split), split).first()
    return PairModel(nodes, Node("master", ("z1", "z2"), list(top.coeffs)), float(top.rmse), int(top.n_train))


def poly_basis(a: Column, b: Column, form: int) -> Column:
    if form not in FORMS:
        raise ValueError(f"unknown polynomial form: {form}")
    return F.array(*[_monomial(a, b, p, q) for p, q in FORMS[form]])
