"""Metric documents in JSON: nested ({"metrics": .., "gate": ..}) and flat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.metrics import GATE_THRESHOLDS

METRICS = ("precision", "recall", "f1", "auc_roc")
LAYOUT = (
    "model string, metrics struct<precision:double,recall:double,f1:double,auc_roc:double>, "
    "gate struct<overall_pass:boolean>, precision double, recall double, f1 double, auc_roc double, gate_status string"
)


def metric_documents(metrics: DataFrame, nested: Column) -> DataFrame:
    """One JSON document per model row."""
    ok = F.lit(True)
    for name, limit in GATE_THRESHOLDS.items():
        ok = ok & (F.col(name) >= limit)
    flat = F.to_json(F.struct("model", *METRICS, F.when(ok, "PASS").otherwise("FAIL").alias("gate_status")))
    deep = F.to_json(F.struct("model", F.struct(*METRICS).alias("metrics"), F.struct(ok.alias("overall_pass")).alias("gate")))
    return metrics.select(F.when(nested, deep).otherwise(flat).alias("document"))


def read_metric_documents(docs: DataFrame, column: str = "document") -> DataFrame:
    d = F.col("d")
    return docs.select(F.from_json(column, LAYOUT).alias("d")).select(
        d["model"].alias("model"), *[F.coalesce(d["metrics"][m], d[m]).alias(m) for m in METRICS],
        F.coalesce(d["gate"]["overall_pass"], d["gate_status"] == "PASS", F.lit(False)).alias("gate"),
    )
