"""Evaluation of a benchmark in one call: normalise, score, measure, gate, describe the model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.models.documents import PairModel
from riskloom.models.engines import shortcut_engine
from riskloom.operators import metrics as M

# Weights of the rule that scores when no model is stored.
RULE_WEIGHTS = {"semantic_risk": 0.5, "proxy_score": 0.3, "velocity_1h": 0.2}


def described(model: PairModel | None) -> Column:
    """The model document of an evaluation: the coefficients that scored, or the rule's weights."""
    if model is None:
        weights = F.struct(*[F.lit(v).alias(k) for k, v in RULE_WEIGHTS.items()])
        return F.to_json(F.struct(F.lit("simple_rule_based_fraud_model").alias("description"), weights.alias("weights")))
    first, *rest = model.master.coeffs
    return F.to_json(F.struct(
        F.lit("pair_trained_fraud_model").alias("description"), F.lit(float(first)).alias("beta0"),
        F.array(*[F.lit(float(c)) for c in rest]).alias("betas"),
    ))


def evaluate_benchmark(rows: DataFrame, model: PairModel | None = None, limits: dict[str, float] | None = None) -> DataFrame:
    """One row for labelled transactions: row_count, fraud_rate, confusion counts, metrics, gate and the model document.

    With a stored model its master coefficients score the raw features, as deployed; without one the rule does. Rows are
    read once. ``limits`` are the least values of the gate.
    """
    normal = S.normalize_benchmark(rows)
    if model is None:
        rule = S.rule_score(F.col("semantic_risk"), F.col("velocity_1h"), F.col("proxy_score"))
        scored = normal.withColumn("score", rule)
    else:
        scored = shortcut_engine(normal, model)
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    ok = F.lit(True)
    for name, limit in (limits or M.GATE_THRESHOLDS).items():
        ok = ok & (F.coalesce(F.col(name), F.lit(0.0)) >= limit)
    return M.evaluate(scored).select(
        n.alias("row_count"), M.ratio(F.col("tp") + F.col("fn"), n).alias("fraud_rate"), "tp", "fp", "fn", "tn",
        "precision", "recall", "f1", "auc_roc", F.when(ok, "PASS").otherwise("FAIL").alias("gate"),
        described(model).alias("model"),
    )
