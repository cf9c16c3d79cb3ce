import json

import pytest
from pyspark.sql import functions as F

from riskloom.models import documents as D
from riskloom.models.evaluation import RULE_WEIGHTS, evaluate_benchmark

ROWS = [(0.9, 12.0, 1.0, 2.0, 1), (0.1, 1.0, 0.0, 0.2, 0), (0.8, 30.0, 0.5, 1.0, 1), (0.2, 0.0, 0.0, 0.1, 0)]
COLUMNS = "semantic_risk double, velocity_1h double, proxy_score double, amount_deviation double, is_fraud int"


def test_rule_when_no_model_is_stored(spark):
    row = evaluate_benchmark(spark.createDataFrame(ROWS, COLUMNS)).first()
    assert (row.row_count, row.fraud_rate, row.tp, row.fp, row.fn, row.tn) == (4, 0.5, 2, 0, 0, 2)
    assert row.auc_roc == row.f1 == 1.0 and row.gate == "PASS"
    assert json.loads(row.model) == {"description": "simple_rule_based_fraud_model", "weights": RULE_WEIGHTS}


def test_stored_model_and_own_limits(spark):
    model = D.PairModel.from_document(D.FRAUD_MODEL)
    rows = spark.createDataFrame(ROWS, COLUMNS)
    row = evaluate_benchmark(rows, model).first()
    beta0, *betas = model.master.coeffs
    scores = [min(1.0, max(0.0, beta0 + sum(b * x for b, x in zip(betas, r)))) for r in ROWS]
    found = sum(s > 0.5 and r[-1] == 1 for s, r in zip(scores, ROWS))
    assert row.tp == found and row.tp + row.fn == 2
    assert json.loads(row.model) == {"description": "pair_trained_fraud_model", "beta0": beta0, "betas": list(betas)}
    assert evaluate_benchmark(rows, None, {"f1": 1.1}).first().gate == "FAIL"


def test_rows_are_read_once(spark):
    """The metrics are made from stored counts per score, not from the rows again."""
    plan = evaluate_benchmark(spark.createDataFrame(ROWS, COLUMNS))._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "amount_deviation" not in plan


@pytest.mark.parametrize("score,label", [(None, 1), (0.9, None)])
def test_nulls_are_counted(spark, score, label):
    rows = spark.createDataFrame([(score, 0.0, 0.0, 0.0, label)], COLUMNS)
    row = evaluate_benchmark(rows.select("*", F.lit(1).alias("score"))).first()
    assert row.tp + row.fp + row.fn + row.tn == row.row_count == 1
