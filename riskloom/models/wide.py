"""Two-layer pair networks over many features: sampled pairs, node selection, linear second layer."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.models import pairs as P
from riskloom.models.pairs import FORMS


@dataclass
class WideNode:
    a: int
    b: int
    form: int
    coeffs: list[float]
    val_mse: float | None = None
    train_mse: float | None = None


@dataclass
class WideModel:
    nodes: list[WideNode]
    layer2: list[float]
    clip_nodes: bool = False
    errors: dict[str, float] = field(default_factory=dict)
    n_features: int = 0
    candidates: int = 0

    def to_document(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_document(text: str) -> "WideModel":
        d = json.loads(text)
        d["nodes"] = [WideNode(**n) for n in d["nodes"]]
        return WideModel(**d)

    def to_published(self) -> dict:
        """The published layout of such a network."""
        nodes = [{"feat_i": n.a, "feat_j": n.b, "form_type": n.form, "coeffs": list(n.coeffs), "val_mse": n.val_mse,
                  "train_mse": n.train_mse} for n in self.nodes]
        return {"n_features": self.n_features, "layer1_nodes": nodes, "layer2_coeffs": list(self.layer2)}

    @staticmethod
    def from_published(d: dict) -> "WideModel":
        nodes = [WideNode(n["feat_i"], n["feat_j"], n["form_type"], n["coeffs"], n.get("val_mse"), n.get("train_mse"))
                 for n in d["layer1_nodes"]]
        return WideModel(nodes, d["layer2_coeffs"], n_features=d.get("n_features", 0))

    def node_outputs(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.nodes)))
        for k, n in enumerate(self.nodes):
            a, b = x[:, n.a], x[:, n.b]
            out[:, k] = sum(c * a**p * b**q for c, (p, q) in zip(n.coeffs, FORMS[n.form]))
        return np.clip(out, 0.0, 1.0) if self.clip_nodes else out


def pair_sample(spark: SparkSession, n_features: int, m: int, seed: int = 42) -> DataFrame:
    """Seeded sample of at most m of the pairs i < j of feature positions."""
    j = spark.range(1, max(n_features, 1)).select(F.col("id").cast("int").alias("b"))
    pairs = j.select(F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("a"), "b")
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), "a", "b"))
    return pairs.withColumn("_mark", mark).orderBy("_mark").limit(m).drop("_mark")


def sampled_pairs(spark: SparkSession, n_features: int, m: int, seed: int) -> list[tuple[int, int]]:
    rows = pair_sample(spark, n_features, m, seed).collect()  # at most m pairs of feature positions
    return sorted((r.a, r.b) for r in rows)


def minmax_array(df: DataFrame, features: str, n: int, eps: float = 1e-8) -> DataFrame:
    """Every position of an array column scaled to [0, 1] by its own range."""
    row = df.agg(*[f(F.get(features, i)).cast("double") for i in range(n) for f in (F.min, F.max)]).first()
    lo, hi = np.array(row[0::2], dtype=float), np.array(row[1::2], dtype=float)
    lows = F.array(*[F.lit(float(v)) for v in lo])
    spans = F.array(*[F.lit(float(v)) for v in hi - lo + eps])
    shifted = F.zip_with(F.col(features).cast("array<double>"), lows, lambda x, m: x - m)
    return df.withColumn(features, F.zip_with(shifted, spans, lambda x, s: x / s))


def _layer2_gram(df: DataFrame, features: str, label: str, split: str, model: WideModel) -> dict[str, np.ndarray]:
    """Gram matrix of [1, node outputs, label] per split, summed over partitions."""
    width = len(model.nodes) + 2
    rows_, cols_ = np.triu_indices(width)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for part, rows in pdf.groupby(split):
                x = np.stack(rows[features].to_numpy()).astype(np.float64)
                y = rows[label].to_numpy(dtype=np.float64)
                z = np.column_stack([np.ones(len(x)), model.node_outputs(x), y])
                total[part] = total.get(part, 0.0) + (z.T @ z)[rows_, cols_]
        for part, upper in total.items():
            yield pd.DataFrame({split: part, "cell": np.arange(len(upper), dtype=np.int32), "v": upper})

    parts = df.select(features, label, split).mapInPandas(partial, f"{split} string, cell int, v double")
    cells = parts.groupBy(split, "cell").agg(F.sum("v").alias("v")).collect()  # 2 * (nodes + 2)^2 / 2 numbers
    grams: dict[str, np.ndarray] = {}
    for r in cells:
        g = grams.setdefault(r[split], np.zeros((width, width)))
        g[rows_[r.cell], cols_[r.cell]] = g[cols_[r.cell], rows_[r.cell]] = r.v
    return grams


def _gram_mse(g: np.ndarray, c: np.ndarray) -> float:
    full = np.append(c, -1.0)
    return float(max(0.0, full @ g @ full) / g[0, 0])


def _node_mse(g: np.ndarray, k: int) -> float:
    """Error of one node's own output against the label."""
    return float(max(0.0, g[k, k] - 2 * g[k, -1] + g[-1, -1]) / g[0, 0])


def score_wide(df: DataFrame, features: str, model: WideModel, out: str = "score", clip: bool = True) -> DataFrame:
    """Second-layer output per row."""
    layer2 = np.asarray(model.layer2)

    @F.pandas_udf("double")
    def predict(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        z = model.node_outputs(np.stack(x.to_numpy()).astype(np.float64))
        y = layer2[0] + z @ layer2[1:]
        return pd.Series(np.clip(y, 0.0, 1.0) if clip else y)

    return df.withColumn(out, predict(F.col(features)))


def train_wide(
    df: DataFrame, features: str, label: str, split: str, n_features: int, *, max_pairs: int,
    forms: Sequence[int] = (2,), keep: int | None = None, clip_nodes: bool = False, seed: int = 42, val: str = "val",
) -> WideModel:
    """Fit sampled pairs in every form from one pass, keep the best on validation rows, then fit layer 2 in a second pass.

    ``keep=None`` keeps every node. ``clip_nodes`` clamps node outputs to [0, 1] before layer 2; the errors of
    clamped outputs are not quadratic and take one more pass. All nodes that layer 2 uses are stored.
    """
    spark = df.sparkSession
    pairs = sampled_pairs(spark, n_features, min(max_pairs, math.comb(n_features, 2)), seed)
    moments = P.wide_pair_moments(df, features, label, split, pairs, forms)
    fits = P.pair_fit(moments, split, forms, val=val)
    chosen = P.topk_nodes(fits, keep) if keep else fits.orderBy("a", "b", "form")
    nodes = [
        WideNode(r.a, r.b, r.form, list(r.coeffs), r.val_mse, r.train_mse) for r in chosen.collect()
    ]  # bounded by max_pairs * forms, or by keep
    model = WideModel(nodes, [], clip_nodes, n_features=n_features, candidates=len(pairs) * len(forms))
    grams = _layer2_gram(df, features, label, split, model)
    train = grams["train"]
    if clip_nodes:
        for k, node in enumerate(nodes):
            node.train_mse, node.val_mse = (_node_mse(grams[part], k + 1) for part in ("train", val))
    c = P.solve(train[:-1, :-1], train[:-1, -1])
    model.layer2 = c.tolist()
    model.errors = {f"{part}_mse": _gram_mse(g, c) for part, g in grams.items()}
    y = F.col(label).cast("double")
    scored = score_wide(df, features, model).groupBy(split).agg(
        F.sum((F.col("score") - y) * (F.col("score") - y)).alias("e"), F.count("*").alias("n")
    ).collect()  # one row per split
    model.errors.update({f"{r[split]}_mse_clipped": r.e / r.n for r in scored})
    model.errors["full_mse_clipped"] = sum(r.e for r in scored) / sum(r.n for r in scored)
    return model


def train_generic(df: DataFrame, features: str, label: str, split: str, n: int, max_nodes: int = 50, seed: int = 42) -> WideModel:
    """At most min(max_nodes, floor(sqrt(2 n))) sampled pairs, node outputs clamped, layer 2 on all nodes."""
    return train_wide(df, features, label, split, n, max_pairs=min(max_nodes, int(math.sqrt(2 * n))),
                      clip_nodes=True, seed=seed)


def train_full(df: DataFrame, features: str, label: str, split: str, n: int, max_nodes: int = 100, seed: int = 42) -> WideModel:
    return train_wide(df, features, label, split, n, max_pairs=max_nodes, clip_nodes=True, seed=seed)


def train_random(df: DataFrame, features: str, label: str, n: int, nodes: int = 50, seed: int = 42) -> WideModel:
    """Random pairs without selection, fitted and judged on all rows."""
    every = df.withColumn("_all", F.lit("train"))
    return train_wide(every, features, label, "_all", n, max_pairs=min(nodes, 2 * n), seed=seed, val="train")


def train_selforg(df: DataFrame, features: str, label: str, split: str, n: int, seed: int = 42) -> WideModel:
    return train_wide(df, features, label, split, n, max_pairs=500, keep=50, seed=seed)


def train_formsearch(df: DataFrame, features: str, label: str, split: str, n: int, seed: int = 42) -> WideModel:
    return train_wide(df, features, label, split, n, max_pairs=300, forms=tuple(FORMS), keep=50, seed=seed)


def model_rows(spark: SparkSession, model: WideModel) -> DataFrame:
    """Layer-1 nodes as a table."""
    rows = [(k, n.a, n.b, n.form, [float(c) for c in n.coeffs], n.val_mse, n.train_mse) for k, n in enumerate(model.nodes)]
    return spark.createDataFrame(
        rows, "rank int, feat_i int, feat_j int, form_type int, coeffs array<double>, val_mse double, train_mse double"
    )


def model_errors(spark: SparkSession, model: WideModel) -> DataFrame:
    rows = [(k, float(v)) for k, v in sorted(model.errors.items())]
    return spark.createDataFrame(rows, "metric string, value double")


def form_histogram(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("form_type").agg(F.count("*").alias("n")).withColumn(
        "percent", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))
    )
