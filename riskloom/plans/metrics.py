"""Profiles, confusion counts, ranking metrics, thresholds and losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.operators import metrics as M
from riskloom.plans import views as V
from riskloom.plans.scalar import r6, r10
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.sources.tables import table


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query("dataset_profile", with_views("txn", """
SELECT count(*) AS n_rows, 4 AS n_features, sum(is_fraud)::bigint AS n_fraud, (count(*)-sum(is_fraud))::bigint AS n_legit,
  round(avg(is_fraud), 6) AS fraud_rate, count(*) FILTER (value IS NULL) AS n_null, round(avg(semantic_risk), 6) AS mean_semantic,
  max(velocity_1h) AS max_velocity, round(avg(amount_deviation), 6) AS mean_deviation FROM txn"""))
def dataset_profile(spark, sf):
    return V.txn(spark, sf).agg(
        F.count("*").alias("n_rows"), F.lit(len(V.FEATURES)).alias("n_features"), F.sum("is_fraud").alias("n_fraud"),
        F.count_if(F.col("is_fraud") == 0).alias("n_legit"), r6("fraud_rate", F.avg("is_fraud")),
        F.count_if(F.col("value").isNull()).alias("n_null"), r6("mean_semantic", F.avg("semantic_risk")),
        F.max("velocity_1h").alias("max_velocity"), r6("mean_deviation", F.avg("amount_deviation")),
    )


@query("class_feature_means", with_views("txn", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (is_fraud=0), 6) AS legit, round(avg({c}) FILTER (is_fraud=1), 6) AS fraud,
  round(avg({c}) FILTER (is_fraud=1) - avg({c}) FILTER (is_fraud=0), 6) AS diff FROM txn""" for c in V.FEATURES)))
def class_feature_means(spark, sf):
    means = V.txn(spark, sf).agg(*[
        F.avg(F.when(F.col("is_fraud") == y, F.col(c))).alias(f"{c}_{y}") for c in V.FEATURES for y in (0, 1)
    ])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}_0").alias("legit"), F.col(f"{c}_1").alias("fraud"))
        for c in V.FEATURES
    ])
    rows = means.select(F.explode(cells).alias("r")).select("r.*")
    return rows.select("feature", r6("legit"), r6("fraud"), r6("diff", F.col("fraud") - F.col("legit")))


@query("epoch_stats", with_views("txn", """
SELECT epoch, count(*) AS n_rows, sum(is_fraud)::bigint AS n_fraud, round(avg(is_fraud), 6) AS fraud_rate FROM txn GROUP BY epoch"""))
def epoch_stats(spark, sf):
    return V.txn(spark, sf).groupBy("epoch").agg(
        F.count("*").alias("n_rows"), F.sum("is_fraud").alias("n_fraud"), r6("fraud_rate", F.avg("is_fraud"))
    )


@query("epoch_pattern_counts", with_views("txn", """
SELECT epoch, pattern, count(*) AS n_fraud FROM txn WHERE is_fraud = 1 GROUP BY epoch, pattern"""))
def epoch_pattern_counts(spark, sf):
    return V.txn(spark, sf).filter("is_fraud = 1").groupBy("epoch", "pattern").agg(F.count("*").alias("n_fraud"))


def counts_sql(cond, extra="", source="scored", group=""):
    return f"""SELECT {extra} count(*) FILTER ({cond} AND is_fraud=1) AS tp, count(*) FILTER ({cond} AND is_fraud=0) AS fp,
  count(*) FILTER (NOT ({cond}) AND is_fraud=1) AS fn, count(*) FILTER (NOT ({cond}) AND is_fraud=0) AS tn FROM {source} {group}"""


PRF = """coalesce(tp::double/nullif(tp+fp,0),0) AS precision, coalesce(tp::double/nullif(tp+fn,0),0) AS recall"""


def prf_sql(counts, extra=""):
    return f"""SELECT *, coalesce(2*precision*recall/nullif(precision+recall,0),0) AS f1 FROM
  (SELECT *, {PRF} FROM ({counts}))"""


def auc_sql(source="scored", default="0.0", score="score", group=""):
    part = f"PARTITION BY {group}" if group else ""
    pick = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""SELECT {pick}coalesce((sum(CASE WHEN is_fraud=1 THEN rk END)
    - sum(is_fraud)::double*(sum(is_fraud)+1)/2)/nullif(sum(is_fraud)::double*(count(*)-sum(is_fraud)),0),{default})::double AS auc_roc
  FROM (SELECT {pick}is_fraud, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER (PARTITION BY {pick}{score}) - 1)/2.0::double AS rk
    FROM {source}) {tail}"""


@query("confusion", with_views("scored", counts_sql("score > 0.5")))
def confusion(spark, sf):
    return M.confusion(V.scored_txn(spark, sf), threshold=0.5)


@query("confusion_inclusive", with_views("scored", counts_sql("semantic_risk >= 0.55")))
def confusion_inclusive(spark, sf):
    return M.confusion(V.scored_txn(spark, sf), score="semantic_risk", threshold=0.55, inclusive=True)


@query("prf_metrics", with_views("scored", f"""
SELECT tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  round(tp/(tp+fp+1e-8), 6) AS precision_eps FROM ({prf_sql(counts_sql('score > 0.55'))})"""))
def prf_metrics(spark, sf):
    df = M.with_prf(M.confusion(V.scored_txn(spark, sf), threshold=0.55))
    eps = M.ratio(F.col("tp"), F.col("tp") + F.col("fp"), M.EPS)
    return df.select("tp", "fp", "fn", "tn", r6("precision"), r6("recall"), r6("f1"), r6("precision_eps", eps))


@query("accuracy", with_views("scored", f"""
SELECT round((tp+tn)::double/(tp+tn+fp+fn), 6) AS accuracy FROM ({counts_sql('score > 0.55')})"""))
def accuracy(spark, sf):
    return M.with_accuracy(M.confusion(V.scored_txn(spark, sf), threshold=0.55)).select(r6("accuracy"))


@query("auc_midrank", with_views("scored", f"SELECT round(auc_roc, 6) AS auc_roc FROM ({auc_sql()})"))
def auc_midrank(spark, sf):
    return M.auc(V.scored_txn(spark, sf)).select(r6("auc_roc"))


@query("auc_sorted", with_views("scored", f"""
SELECT epoch, round(auc_roc, 6) AS auc_roc FROM ({auc_sql(default='0.5', group='epoch')})"""))
def auc_sorted(spark, sf):
    return M.auc(V.scored_txn(spark, sf), one_class=0.5, by=["epoch"]).select("epoch", r6("auc_roc"))


@query("auc_trapezoid", with_views("scored", f"SELECT round(auc_roc, 6) AS auc_roc FROM ({auc_sql(default='0.5')})"))
def auc_trapezoid(spark, sf):
    return M.auc_trapezoid(V.scored_txn(spark, sf)).select(r6("auc_roc"))


@query("cum_positives", with_views("scored", """
SELECT round(score, 6) AS score, pos, neg, sum(pos) OVER w::bigint AS cum_pos, sum(neg) OVER w::bigint AS cum_neg FROM (
  SELECT score, sum(is_fraud)::bigint AS pos, sum(1-is_fraud)::bigint AS neg FROM scored GROUP BY score)
WINDOW w AS (ORDER BY score DESC)""").replace("OVER w::bigint", "OVER w").replace(
    "sum(pos) OVER w", "(sum(pos) OVER w)::bigint").replace("sum(neg) OVER w", "(sum(neg) OVER w)::bigint"))
def cum_positives(spark, sf):
    return M.roc_points(V.scored_txn(spark, sf)).select(r6("score"), "pos", "neg", "cum_pos", "cum_neg")


@query("avg_rank", with_views("scored", """
SELECT txn_id, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1)/2.0::double AS avg_rank FROM scored"""))
def avg_rank(spark, sf):
    return M.average_ranks(V.scored_txn(spark, sf).select("txn_id", "score")).select("txn_id", "avg_rank")


def sweep_sql(grid, cond=">="):
    ts = ", ".join(f"({t}::double)" for t in grid)
    counts = f"""SELECT t AS threshold, count(*) FILTER (score {cond} t AND is_fraud=1) AS tp,
    count(*) FILTER (score {cond} t AND is_fraud=0) AS fp, count(*) FILTER (NOT score {cond} t AND is_fraud=1) AS fn,
    count(*) FILTER (NOT score {cond} t AND is_fraud=0) AS tn FROM scored, (VALUES {ts}) g(t) GROUP BY t"""
    return prf_sql(counts)


FULL = M.grid(*M.SWEEP_GRID)
BEST = M.grid(*M.BEST_F1_GRID)
COARSE = M.grid(*M.COARSE_GRID)


def sweep_cols(df):
    return df.select("threshold", "tp", "fp", "fn", "tn", r6("precision"), r6("recall"), r6("f1"),
                     "precision_ok", "recall_ok")


SWEEP_SELECT = """SELECT threshold, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, precision >= 0.5 AS precision_ok, recall >= 0.4 AS recall_ok"""


@query("threshold_sweep", with_views("scored", f"{SWEEP_SELECT} FROM ({sweep_sql(FULL)})"))
def threshold_sweep(spark, sf):
    return sweep_cols(M.threshold_sweep(V.scored_txn(spark, sf), FULL))


@query("threshold_sweep_coarse", with_views("scored", f"{SWEEP_SELECT} FROM ({sweep_sql(COARSE, '>')})"))
def threshold_sweep_coarse(spark, sf):
    return sweep_cols(M.threshold_sweep(V.scored_txn(spark, sf), COARSE, inclusive=False))


@query("best_f1_threshold", with_views("scored", f"""
SELECT CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END AS threshold, tp, fp, fn, tn, round(f1, 6) AS f1
FROM ({sweep_sql(BEST)}) ORDER BY f1 DESC, threshold LIMIT 1"""))
def best_f1_threshold(spark, sf):
    top = M.best_f1(M.threshold_sweep(V.scored_txn(spark, sf), BEST))
    return top.select("threshold", "tp", "fp", "fn", "tn", r6("f1"))


@query("feasible_threshold", with_views("scored", f"""
SELECT bool_or(precision >= 0.5 AND recall >= 0.4) AS feasible FROM ({sweep_sql(FULL)})"""))
def feasible_threshold(spark, sf):
    return M.feasible(M.threshold_sweep(V.scored_txn(spark, sf), FULL))


@query("regression_errors", with_views("scored", """
SELECT round(avg(d*d), 6) AS mse, round(sqrt(avg(d*d)), 6) AS rmse, round(avg(c*c), 6) AS mse_clipped, round(sqrt(avg(c*c)), 6) AS rmse_clipped
FROM (SELECT p - is_fraud AS d, greatest(0.0, least(1.0, p)) - is_fraud AS c FROM (SELECT 1.6*score - 0.3 AS p, is_fraud FROM scored))"""))
def regression_errors(spark, sf):
    df = V.scored_txn(spark, sf)
    out = M.squared_errors(df, F.lit(1.6) * F.col("score") - F.lit(0.3), F.col("is_fraud"))
    return out.select(*[r6(c) for c in ("mse", "rmse", "mse_clipped", "rmse_clipped")])


LL = "-(y*ln(p+1e-8) + (1-y)*ln(1-p+1e-8))"


@query("log_loss", with_views("scored", f"""
SELECT round(avg({LL}), 6) AS log_loss, round(avg(CASE WHEN y=1 THEN 12 ELSE 1 END * {LL}), 6) AS weighted_log_loss
FROM (SELECT score AS p, is_fraud AS y FROM scored)"""))
def log_loss(spark, sf):
    out = M.log_loss(V.scored_txn(spark, sf), F.col("score"), F.col("is_fraud"), weight=12.0)
    return out.select(r6("log_loss"), r6("weighted_log_loss"))


@query("focal_loss", with_views("scored", f"""
SELECT round(avg(pow(1 - CASE WHEN y=1 THEN p ELSE 1-p END, 2) * {LL}), 6) AS focal_loss FROM (SELECT score AS p, is_fraud AS y FROM scored)"""))
def focal_loss(spark, sf):
    return M.focal_loss(V.scored_txn(spark, sf), F.col("score"), F.col("is_fraud")).select(r6("focal_loss"))


@query("class_weight", with_views("txn", """
SELECT round(r, 6) AS rate, round((1-r)/(r+1e-8), 6) AS raw_weight, round(least((1-r)/(r+1e-8), 5), 6) AS weight
FROM (SELECT avg(is_fraud) AS r FROM txn)"""))
def class_weight(spark, sf):
    return M.class_weight(V.txn(spark, sf), cap=5.0).select(r6("rate"), r6("raw_weight"), r6("weight"))


@query("detection_by_pattern", with_views("scored", """
SELECT pattern, count(*) AS n_fraud, round(avg(CASE WHEN score > 0.55 THEN 1 ELSE 0 END), 6) AS detected
FROM scored WHERE is_fraud = 1 GROUP BY pattern"""))
def detection_by_pattern(spark, sf):
    hit = F.when(F.col("score") > 0.55, 1).otherwise(0)
    return V.scored_txn(spark, sf).filter("is_fraud = 1").groupBy("pattern").agg(
        F.count("*").alias("n_fraud"), r6("detected", F.avg(hit))
    )


@query("drift_recall_drop", with_views("scored", f""", c AS ({prf_sql(counts_sql('score > 0.55', extra='epoch,', group='GROUP BY epoch'))}),
a AS ({auc_sql(default='0.5', group='epoch')})
SELECT round(max(recall) FILTER (epoch='stable'), 6) AS recall_stable, round(max(recall) FILTER (epoch='drift'), 6) AS recall_drift,
  round(max(recall) FILTER (epoch='stable') - max(recall) FILTER (epoch='drift'), 6) AS recall_drop,
  round(max(auc_roc) FILTER (epoch='stable'), 6) AS auc_stable, round(max(auc_roc) FILTER (epoch='drift'), 6) AS auc_drift
FROM c JOIN a USING (epoch)"""))
def drift_recall_drop(spark, sf):
    per = M.evaluate(V.scored_txn(spark, sf), threshold=0.55, one_class=0.5, by=["epoch"])

    def of(c, epoch):
        return F.max(F.when(F.col("epoch") == epoch, F.col(c)))

    return per.agg(
        r6("recall_stable", of("recall", "stable")), r6("recall_drift", of("recall", "drift")),
        r6("recall_drop", of("recall", "stable") - of("recall", "drift")),
        r6("auc_stable", of("auc_roc", "stable")), r6("auc_drift", of("auc_roc", "drift")),
    )


# Weights and threshold of the three compared variants.
VARIANTS = [
    ("baseline", {"semantic_risk": 0.5, "proxy_score": 0.3, "velocity_1h": 0.2, "amount_deviation": 0.0}, 0.55),
    ("tuned_threshold", {"semantic_risk": 0.5, "proxy_score": 0.3, "velocity_1h": 0.2, "amount_deviation": 0.0}, 0.60),
    ("tuned_weights", {"semantic_risk": 0.45, "proxy_score": 0.35, "velocity_1h": 0.15, "amount_deviation": 0.05}, 0.55),
]


def variant_sql():
    parts = []
    for name, w, t in VARIANTS:
        parts.append(f"""SELECT '{name}' AS variant, {t}::double AS threshold, is_fraud, greatest(0.0, least(1.0,
  {w['semantic_risk']}*semantic_risk + {w['proxy_score']}*proxy_score + {w['velocity_1h']}*least(1.0, velocity_1h/20)
  + {w['amount_deviation']}*least(1.0, amount_deviation/1000)))::double AS score FROM txn""")
    counts = counts_sql("score > threshold", extra="variant, threshold,", source="v", group="GROUP BY variant, threshold")
    return with_views("txn", f""", v AS ({' UNION ALL '.join(parts)}), m AS ({prf_sql(counts)}),
half AS ({prf_sql(counts_sql('score > 0.5', extra='variant,', source='v', group='GROUP BY variant'))}),
a AS ({auc_sql(source='v', group='variant')})
SELECT variant, threshold, m.tp, m.fp, m.fn, m.tn, round(m.precision, 6) AS precision, round(m.recall, 6) AS recall,
  round(m.f1, 6) AS f1, round(auc_roc, 6) AS auc_roc, round(half.precision, 6) AS precision_at_half,
  round(half.recall, 6) AS recall_at_half, round(half.f1, 6) AS f1_at_half FROM m JOIN a USING (variant) JOIN half USING (variant)""")


@query("variant_comparison", variant_sql())
def variant_comparison(spark, sf):
    cols = [F.col(c) for c in V.FEATURES]
    cells = F.array(*[
        F.struct(F.lit(n).alias("variant"), F.lit(t).alias("threshold"), S.weighted_score(w, *cols).alias("score"))
        for n, w, t in VARIANTS
    ])
    rows = V.txn(spark, sf).select("is_fraud", F.explode(cells).alias("v")).select("is_fraud", "v.*")
    counts = M.score_counts(rows, by=["variant", "threshold"])  # all three results follow from it
    own = M.with_prf(M.confusion_of_counts(counts, F.col("threshold"), by=["variant", "threshold"]))
    half = M.with_prf(M.confusion_of_counts(counts, 0.5, by=["variant"])).select(
        "variant", *[F.col(c).alias(f"{c}_at_half") for c in ("precision", "recall", "f1")]
    )
    out = own.join(half, "variant").join(M.auc_of_counts(counts, by=["variant"]), "variant")
    return out.select("variant", "threshold", "tp", "fp", "fn", "tn", *[r6(c) for c in (
        "precision", "recall", "f1", "auc_roc", "precision_at_half", "recall_at_half", "f1_at_half")])


@query("health_score", with_views("infra", """
SELECT round(avg(architecture_efficiency), 6) AS health_score, CASE WHEN avg(architecture_efficiency) > 0.75 THEN 'OK'
  WHEN avg(architecture_efficiency) > 0.45 THEN 'WARN' ELSE 'CRITICAL' END AS status
FROM infra WHERE cs_auth_status IS NOT NULL"""))
def health_score(spark, sf):
    mean = F.avg("architecture_efficiency")
    return V.infra(spark, sf).filter("cs_auth_status IS NOT NULL").agg(
        r6("health_score", mean), S.health_status(mean).alias("status")
    )
