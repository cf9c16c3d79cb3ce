"""Pair models: parameters, coefficient table, JSON documents and scoring expressions."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import clip01

TERMS = ("intercept", "a", "b", "ab")
COEF_SCHEMA = "model_id string, layer int, position int, node string, inputs array<string>, term string, coef double"


@dataclass
class Node:
    """y = c0 + c1*a + c2*b + c3*a*b of two named inputs."""

    name: str
    inputs: tuple[str, str]
    coeffs: list[float]

    def column(self, inputs: dict[str, Column] | None = None) -> Column:
        a, b = ((inputs or {}).get(n, F.col(n)) for n in self.inputs)
        c = [F.lit(float(x)) for x in self.coeffs]
        return c[0] + c[1] * a + c[2] * b + c[3] * a * b


@dataclass
class PairModel:
    """Two first-layer nodes and a master node on their outputs z1 and z2."""

    nodes: list[Node]
    master: Node
    rmse: float | None = None
    training_rows: int | None = None
    extra: dict = field(default_factory=dict)

    def raw_score(self) -> Column:
        z = {f"z{i + 1}": n.column() for i, n in enumerate(self.nodes)}
        return self.master.column(z)

    def score(self) -> Column:
        return clip01(self.raw_score())

    def to_document(self) -> dict:
        return {
            "beta0": self.master.coeffs[0], "betas": list(self.master.coeffs[1:]),
            "layer1": [
                {"node": n.name, "intercept": n.coeffs[0], "coeffs": list(n.coeffs[1:]), "inputs": list(n.inputs)}
                for n in self.nodes
            ],
            "final_rmse": self.rmse, "training_samples": self.training_rows, **self.extra,
        }

    @staticmethod
    def from_document(doc: dict | str) -> "PairModel":
        d = json.loads(doc) if isinstance(doc, str) else doc
        nodes = [Node(n["node"], tuple(n["inputs"]), [n["intercept"], *n["coeffs"]]) for n in d["layer1"]]
        master = Node("master", ("z1", "z2"), [d["beta0"], *d["betas"]])
        return PairModel(nodes, master, d.get("final_rmse"), d.get("training_samples"))

    @staticmethod
    def from_health_document(
        doc: dict | str, inputs: tuple[tuple[str, str], tuple[str, str]] = (("x1", "x3"), ("x1", "x2"))
    ) -> "PairModel":
        """The health document does not name its inputs, so the caller does."""
        d = json.loads(doc) if isinstance(doc, str) else doc
        first, second = d["layers"]
        nodes = [
            Node(k, pair, [first[k]["intercept"], *first[k]["coeffs"]])
            for k, pair in zip(("node_z1", "node_z2"), inputs)
        ]
        m = second["master_node"]
        master = Node("master", ("z1", "z2"), [m["intercept"], *m["coeffs"]])
        return PairModel(nodes, master, d.get("final_rmse"), d.get("training_samples"))

    def to_table(self, spark: SparkSession, model_id: str) -> DataFrame:
        rows = [
            (model_id, layer, position, n.name, list(n.inputs), term, float(c))
            for layer, nodes in ((1, self.nodes), (2, [self.master])) for position, n in enumerate(nodes)
            for term, c in zip(TERMS, n.coeffs)
        ]
        return spark.createDataFrame(rows, COEF_SCHEMA)

    @staticmethod
    def from_table(df: DataFrame, model_id: str) -> "PairModel":
        rows = df.filter(F.col("model_id") == model_id).collect()  # 12 coefficients
        nodes: dict[tuple[int, str], Node] = {}
        for r in sorted(rows, key=lambda r: (r.layer, r.position)):
            n = nodes.setdefault((r.layer, r.position), Node(r.node, tuple(r.inputs), [0.0] * 4))
            n.coeffs[TERMS.index(r.term)] = r.coef
        layer1 = [n for (layer, _), n in nodes.items() if layer == 1]
        master = next(n for (layer, _), n in nodes.items() if layer == 2)
        return PairModel(layer1, master)


def shortcut_score(model: PairModel, features: list[str]) -> Column:
    """Master coefficients applied to raw features in order; features beyond the coefficients are ignored."""
    total = F.lit(float(model.master.coeffs[0]))
    for c, name in zip(model.master.coeffs[1:], features):
        total = total + F.lit(float(c)) * F.col(name)
    return clip01(total)


def size_and_bounds(coefs: DataFrame, max_coef: float = 50.0, nodes: int = 2) -> DataFrame:
    """Per model: number of first-layer nodes, largest absolute coefficient, size of the exported document."""
    doc = F.to_json(F.sort_array(F.collect_list(F.struct("layer", "node", "term", "coef"))))
    return coefs.groupBy("model_id").agg(
        F.count_distinct(F.when(F.col("layer") == 1, F.col("node"))).alias("n_nodes"),
        F.max(F.abs("coef")).alias("max_coef"), F.octet_length(doc).cast("bigint").alias("n_bytes"),
    ).withColumns({
        "nodes_ok": F.col("n_nodes") == nodes, "coef_ok": F.col("max_coef") < max_coef,
        "size_ok": F.col("n_bytes") < 2048,
    })


# Published parameters of the fraud model and of the health model.
FRAUD_MODEL = {
    "beta0": -0.009689705844712562,
    "betas": [0.8216057667849549, 0.6615707085936392, -0.4264171385403655],
    "layer1": [
        {
            "node": "node_x1_x4", "intercept": 0.005966401341109273,
            "coeffs": [-0.07399743781271856, -0.26370474926502885, 2.126668944215227], "inputs": ["x1", "x4"],
        },
        {
            "node": "node_x1_x2", "intercept": -0.08181515067111939,
            "coeffs": [0.27537947200385815, 19.15510787463157, 74.26247969086677], "inputs": ["x1", "x2"],
        },
    ],
    "final_rmse": 0.09594441798057374, "training_samples": 35000,
}
HEALTH_MODEL = {
    "layers": [
        {
            "node_z1": {
                "intercept": 0.506894767259105,
                "coeffs": [-0.618848722301903, 0.3527921736377441, -0.179590401568851],
            },
            "node_z2": {
                "intercept": 0.8790998700537569,
                "coeffs": [-0.6278932080372912, -0.14915441436066196, -0.2577318893450157],
            },
        },
        {
            "master_node": {
                "intercept": -0.008913017789488166,
                "coeffs": [0.4876533075145524, 0.44476163321564105, 0.17656396909695649],
            },
        },
    ],
    "final_rmse": 0.06751334847615965, "training_samples": 6860,
}
