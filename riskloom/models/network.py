"""Dense networks: forward pass over stored weights, embeddings, and training with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-8
LIMIT = 500.0
EMBEDDING_DIM = 32

# Weights are shipped to every task, so their size is checked.
MAX_WEIGHT_BYTES = 256 * 1024 * 1024

# Hidden layer widths of the deep classifier.
HIDDEN_LAYERS = (512, 256, 128, 64, 32)


@dataclass
class DenseNetwork:
    """Weight matrices (inputs x outputs), biases and, for all but the last layer, optional batch-norm parameters."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]
    gamma: list[np.ndarray] | None = None
    beta: list[np.ndarray] | None = None
    mean: list[np.ndarray] | None = None
    var: list[np.ndarray] | None = None
    x_mean: np.ndarray | None = None
    x_std: np.ndarray | None = None

    @staticmethod
    def from_document(text: str) -> "DenseNetwork":
        """Network of a published JSON document: weights, biases, bn_* and normalization, the latter two optional."""
        d = json.loads(text)

        def arrays(key: str) -> list[np.ndarray] | None:
            return [np.array(x, dtype=float) for x in d[key]] if key in d else None

        scale = {k: np.array(v, dtype=float) for k, v in d.get("normalization", {}).items()}
        return DenseNetwork(
            arrays("weights"), [b.ravel() for b in arrays("biases")],
            *[None if (x := arrays(key)) is None else [v.ravel() for v in x]
              for key in ("bn_gamma", "bn_beta", "bn_running_mean", "bn_running_var")],
            scale.get("X_mean"), scale.get("X_std"),
        )

    def to_document(self) -> str:
        """The same layout as text."""
        parts = {"bn_gamma": self.gamma, "bn_beta": self.beta, "bn_running_mean": self.mean, "bn_running_var": self.var}
        doc = {"weights": [w.tolist() for w in self.weights], "biases": [b.tolist() for b in self.biases]}
        doc |= {k: [x.tolist() for x in v] for k, v in parts.items() if v is not None}
        if self.x_mean is not None:
            doc["normalization"] = {"X_mean": self.x_mean.tolist(), "X_std": self.x_std.tolist()}
        return json.dumps(doc)

    def check_size(self) -> None:
        size = sum(w.nbytes for w in self.weights)
        if size > MAX_WEIGHT_BYTES:
            raise ValueError(f"network weights of {size} bytes are too large to ship to every task")

    def hidden(self, x: np.ndarray) -> np.ndarray:
        a = x if self.x_mean is None else (x - self.x_mean) / (self.x_std + EPS)
        for i in range(len(self.weights) - 1):
            z = a @ self.weights[i] + self.biases[i]
            if self.gamma is not None:
                z = self.gamma[i] * (z - self.mean[i]) / np.sqrt(self.var[i] + EPS) + self.beta[i]
            a = np.maximum(z, 0.0)
        return a

    def forward(self, x: np.ndarray) -> np.ndarray:
        z = self.hidden(x) @ self.weights[-1] + self.biases[-1]
        return (1.0 / (1.0 + np.exp(-np.clip(z, -LIMIT, LIMIT)))).ravel()


def _matrix(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy()).astype(np.float64)


def nn_forward(df: DataFrame, features: str, net: DenseNetwork, out: str = "score") -> DataFrame:
    net.check_size()

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(net.forward(_matrix(x)) if len(x) else np.zeros(0))

    return df.withColumn(out, run(F.col(features)))


def nn_embedding(df: DataFrame, features: str, net: DenseNetwork, out: str = "embedding") -> DataFrame:
    """Output of the last hidden layer."""
    net.check_size()

    @F.pandas_udf("array<float>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(list(net.hidden(_matrix(x)).astype(np.float32)) if len(x) else [])

    return df.withColumn(out, run(F.col(features)))


def _noise(key: Column, tag: str, i: int) -> Column:
    """Deterministic value in [-1, 1) from the key."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(tag), F.lit(str(i)), key.cast("string"))), 1, 8), 16, 10)
    return bits.cast("double") / F.lit(2.0**31) - F.lit(1.0)


def pseudo_embedding(key: Column, sem: Column, vel: Column, proxy: Column, amt: Column) -> Column:
    """32 values without a network: four scaled features, the same with 10 % jitter, 24 values around their mean.

    Noise comes from a hash of the row's key and has the spread of the normal noise it stands for, so a row always
    gets the same vector.
    """
    base = [sem, vel / F.lit(50.0), proxy, amt / F.lit(3.0)]
    mean = (base[0] + base[1] + base[2] + base[3]) / F.lit(4.0)
    spread = 3.0**0.5
    jitter = [b * (F.lit(1.0) + F.lit(0.1 * spread) * _noise(key, "jitter", i)) for i, b in enumerate(base)]
    rest = [mean + F.lit(0.2 * spread) * _noise(key, "rest", i) for i in range(EMBEDDING_DIM - 8)]
    return F.array(*[c.cast("float") for c in [*base, *jitter, *rest]])


def train_mlp(
    df: DataFrame, features: str, label: str, hidden: Sequence[int], n_features: int, weight_cap: float = 12.0,
    max_iter: int = 30, seed: int = 42,
) -> MultilayerPerceptronClassificationModel:
    """Multilayer perceptron; Spark's has no row weights, so the rare class is repeated up to the class weight."""
    rate = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    times = max(1, round(min((1.0 - rate) / (rate + EPS), weight_cap)))
    copies = F.when(F.col(label) == 1, F.lit(times)).otherwise(1)
    rows = df.withColumn("_c", F.explode(F.sequence(F.lit(1), copies))).select(
        array_to_vector(F.col(features).cast("array<double>")).alias("features"),
        F.col(label).cast("double").alias("label"),
    )
    layers = [n_features, *hidden, 2]
    return MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed, blockSize=128).fit(rows)


def score_mlp(df: DataFrame, features: str, model: MultilayerPerceptronClassificationModel, out: str = "score") -> DataFrame:
    vec = df.withColumn("features", array_to_vector(F.col(features).cast("array<double>")))
    scored = model.transform(vec).withColumn(out, F.get(vector_to_array("probability"), 1))
    return scored.select(*df.columns, out)
