"""Scoring engines, evaluation, gates and the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.models import documents as D
from riskloom.models.engines import compare_engines, get_engine
from riskloom.models.evaluation import evaluate_benchmark as evaluate
from riskloom.operators import gates as G
from riskloom.operators import metrics as M
from riskloom.plans import views as V
from riskloom.plans.metrics import PRF, auc_sql, counts_sql, prf_sql
from riskloom.plans.scalar import MD5, HASH_TEXT, r6, r10
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.session import materialize
from riskloom.sources.tables import table

FRAUD = D.PairModel.from_document(D.FRAUD_MODEL)
HEALTH = D.PairModel.from_health_document(D.HEALTH_MODEL)


def node_sql(n: D.Node, names: dict[str, str]) -> str:
    a, b = (names[i] for i in n.inputs)
    c = [f"({x!r}::double)" if "e" in repr(x) else f"{x!r}e0" for x in n.coeffs]
    return f"({c[0]} + {c[1]}*{a} + {c[2]}*{b} + {c[3]}*{a}*{b})"


def model_sql(m: D.PairModel, names: dict[str, str], source: str) -> str:
    """Rows of ``source`` with z1, z2 and the raw master output."""
    inner = f"SELECT *, {node_sql(m.nodes[0], names)} AS z1, {node_sql(m.nodes[1], names)} AS z2 FROM {source}"
    return f"SELECT *, {node_sql(m.master, {'z1': 'z1', 'z2': 'z2'})} AS raw FROM ({inner})"


X_NAMES = {"x1": "semantic_risk", "x2": "(velocity_1h/50)", "x3": "proxy_score", "x4": "amount_deviation"}
PAIR_SQL = f"""SELECT *, greatest(0.0, least(1.0, raw))::double AS pair_score FROM ({model_sql(FRAUD, X_NAMES, 'txn')})"""
SHORT = "greatest(0.0, least(1.0, {}))::double".format(
    " + ".join([f"{FRAUD.master.coeffs[0]!r}e0"] + [
        f"{c!r}e0*{f}" for c, f in zip(FRAUD.master.coeffs[1:], V.FEATURES)])
)
HASH = f"round({MD5.format(c=HASH_TEXT)}, 2)"


@query("score_pair_model", with_views("txn", f"""
SELECT txn_id, round(pair_score, 6) AS score, CASE WHEN pair_score > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM ({PAIR_SQL})"""))
def score_pair_model(spark, sf):
    return get_engine("pair_model")(V.txn(spark, sf)).select("txn_id", r6("score"), "decision")


@query("score_linear_shortcut", with_views("txn", f"""
SELECT txn_id, round({SHORT}, 6) AS score, CASE WHEN {SHORT} > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM txn"""))
def score_linear_shortcut(spark, sf):
    return get_engine("pair_shortcut")(V.txn(spark, sf)).select("txn_id", r6("score"), "decision")


H_NAMES = {"x1": "(amazon_api_latency/2000)", "x2": "cs_auth_status", "x3": "(system_cpu_load/100)"}


@query("score_health", with_views("infra", f"""
SELECT order_id, round(raw, 9) AS efficiency, CASE WHEN raw > 0.75 THEN 'OK' WHEN raw > 0.45 THEN 'WARN' ELSE 'CRITICAL' END AS status
FROM ({model_sql(HEALTH, H_NAMES, 'infra')}) WHERE cs_auth_status IS NOT NULL"""))
def score_health(spark, sf):
    rows = V.infra(spark, sf).filter("cs_auth_status IS NOT NULL").withColumns({
        "x1": F.col("amazon_api_latency") / F.lit(2000.0), "x2": F.col("cs_auth_status"),
        "x3": F.col("system_cpu_load") / F.lit(100.0),
    })
    raw = HEALTH.raw_score()
    return rows.select("order_id", F.round(raw, 9).alias("efficiency"), S.health_status(raw).alias("status"))


@query("broadcast_stats", with_views("scaled", f"""
SELECT txn_id, round(greatest(0.0, least(1.0, raw))::double, 6) AS score, round((x4 - lo)/(hi - lo + 1e-8), 6) AS x4_scaled
FROM ({model_sql(FRAUD, {k: k for k in X_NAMES}, 'scaled')}), (SELECT min(x4) AS lo, max(x4) AS hi FROM scaled)"""))
def broadcast_stats(spark, sf):
    """One-row parameters (a stored model, the range of a column) applied to all rows as literals and subqueries."""
    df = V.scaled_txn(spark, sf)
    model = D.PairModel.from_table(FRAUD.to_table(spark, "fraud"), "fraud")
    lo, hi = df.agg(F.min("x4")).scalar(), df.agg(F.max("x4")).scalar()
    return df.select("txn_id", r6("score", model.score()), r6("x4_scaled", (F.col("x4") - lo) / (hi - lo + F.lit(1e-8))))


@query("engine_dispatch", with_views("txn", f"""
SELECT txn_id, 'pair_model' AS engine, round(pair_score, 6) AS score, CASE WHEN pair_score > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM ({PAIR_SQL})
UNION ALL SELECT txn_id, 'hash', {HASH}, CASE WHEN {HASH} > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END FROM txn"""))
def engine_dispatch(spark, sf):
    rows, cells = V.txn(spark, sf), []
    for name in ("pair_model", "no such engine"):  # both engines on one frame, so its rows are computed once
        names = {c: f"{c}_{len(cells)}" for c in ("engine", "score", "decision")}
        rows = get_engine(name)(rows).withColumnsRenamed(names)
        cells.append(F.struct(*[F.col(new).alias(c) for c, new in names.items()]))
    out = rows.select("txn_id", F.explode(F.array(*cells)).alias("r")).select("txn_id", "r.*")
    return out.select("txn_id", "engine", r6("score"), "decision")


REPLY = "CASE txn_id%4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.25 WHEN 2 THEN 0.5 ELSE 1.0 END"


@query("engines_compare", with_views("txn", f""", s AS (SELECT *, {SHORT} AS p, {HASH} AS h, ({REPLY})::double AS r FROM txn),
d AS (SELECT *, CASE WHEN p > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS pd, CASE WHEN h > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS hd,
  CASE WHEN r > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS rd FROM s)
SELECT txn_id, round(p, 6) AS pair_shortcut_score, pd AS pair_shortcut_decision, h AS hash_score, hd AS hash_decision,
  r AS reply_score, rd AS reply_decision, CASE WHEN pd = hd AND hd = rd THEN 'YES' ELSE 'NO' END AS agree FROM d"""))
def engines_compare(spark, sf):
    k = F.col("txn_id") % 4
    reply = F.when(k == 0, "0.9").when(k == 1, "Risk: 0.25, low").when(k == 2, "").otherwise("2 or rather 1.0")
    out = compare_engines(V.txn(spark, sf).withColumn("response", reply), "txn_id", ["pair_shortcut", "hash", "reply"])
    return out.withColumn("pair_shortcut_score", F.round("pair_shortcut_score", 6))


@query("engines_compare_failed", with_views("txn", f"""
SELECT txn_id, {HASH} AS hash_score, CASE WHEN {HASH} > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS hash_decision,
  NULL::double AS reply_score, 'ERROR' AS reply_decision, 'YES' AS agree FROM txn"""))
def engines_compare_failed(spark, sf):
    return compare_engines(V.txn(spark, sf), "txn_id", ["hash", "reply"])


@query("distinct_decisions", with_views("txn", f"""
SELECT txn_id, list_sort(list_distinct([CASE WHEN {SHORT} > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END,
  CASE WHEN {HASH} > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END])) AS decisions FROM txn"""))
def distinct_decisions(spark, sf):
    out = compare_engines(V.txn(spark, sf), "txn_id", ["pair_shortcut", "hash"])
    both = F.array("pair_shortcut_decision", "hash_decision")
    return out.select("txn_id", F.array_sort(F.array_distinct(both)).alias("decisions"))


METRIC_COLS = ("precision", "recall", "f1", "auc_roc")
EVAL_SQL = f"""m AS ({prf_sql(counts_sql('score > 0.5'))}), a AS ({auc_sql()})"""
LIMITS = "(VALUES ('f1', 0.45::double), ('precision', 0.50::double), ('recall', 0.40::double), ('auc_roc', 0.78::double)) l(metric, lim)"


def long_sql(source):
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS value FROM {source}" for m in METRIC_COLS)


@query("evaluate_benchmark", with_views("scored", f""", {EVAL_SQL},
g AS (SELECT CASE WHEN bool_and(value >= lim) THEN 'PASS' ELSE 'FAIL' END AS gate FROM ({long_sql('(SELECT * FROM m, a)')}) JOIN {LIMITS} USING (metric))
SELECT (SELECT count(*) FROM scored) AS row_count, round((SELECT avg(is_fraud) FROM scored), 6) AS fraud_rate, tp, fp, fn, tn,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc, gate,
  '{{"description":"simple_rule_based_fraud_model","weights":{{"semantic_risk":0.5,"proxy_score":0.3,"velocity_1h":0.2}}}}' AS model
FROM m, a, g"""))
def evaluate_benchmark(spark, sf):
    """Normalise, score with the rule model, compute all metrics and apply the gate."""
    out = evaluate(V.txn(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("fraud_rate", *METRIC_COLS)})


@query("evaluate_benchmark_model", with_views("txn", f""", scored AS (SELECT is_fraud, {SHORT} AS score FROM txn), {EVAL_SQL}
SELECT tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc FROM m, a"""))
def evaluate_benchmark_model(spark, sf):
    """The same with the stored model as deployed (master coefficients on raw features)."""
    return evaluate(V.txn(spark, sf), FRAUD).select("tp", "fp", "fn", "tn", *[r6(c) for c in METRIC_COLS])


def epoch_metrics(spark, sf):
    return M.evaluate(V.scored_txn(spark, sf), threshold=0.5, by=["epoch"])


@query("benchmark_gate", with_views("scored", f""", m AS ({prf_sql(counts_sql('score > 0.5', extra='epoch,', group='GROUP BY epoch'))}),
a AS ({auc_sql(group='epoch')}), w AS (SELECT * FROM m JOIN a USING (epoch)),
c AS (SELECT epoch, metric, round(value, 6) AS value, lim AS "limit", CASE WHEN value >= lim THEN 'PASS' ELSE 'FAIL' END AS status
  FROM ({" UNION ALL ".join(f"SELECT epoch, '{m}' AS metric, {m} AS value FROM w" for m in METRIC_COLS)}) JOIN {LIMITS} USING (metric))
SELECT *, CASE WHEN bool_and(status='PASS') OVER (PARTITION BY epoch) THEN 'PASS' ELSE 'FAIL' END AS gate FROM c"""))
def benchmark_gate(spark, sf):
    metrics = epoch_metrics(spark, sf)
    checks = G.gate_checks(metrics, ["epoch"])
    return checks.join(G.gate_result(metrics, ["epoch"]), "epoch").select(
        "epoch", "metric", r6("value"), "limit", "status", "gate"
    )


@query("health_gate", with_views("infra log main_table", """
SELECT 'record' AS source, round(h, 6) AS health_score, CASE WHEN h < 0.35 THEN 'DISABLED' ELSE 'ENABLED' END AS status
FROM (SELECT avg(architecture_efficiency) AS h FROM infra WHERE cs_auth_status IS NOT NULL)
UNION ALL SELECT 'synced rows', CASE WHEN (SELECT count(*) FROM main_table) > 0 THEN 0.8::double ELSE 0.5::double END, 'ENABLED'
UNION ALL SELECT 'no rows', 0.5::double, 'ENABLED' UNION ALL SELECT 'nothing readable', 0.75::double, 'ENABLED' UNION ALL SELECT 'record without score', 0.75::double, 'ENABLED'"""))
def health_gate(spark, sf):
    record = V.infra(spark, sf).filter("cs_auth_status IS NOT NULL").agg(
        F.avg("architecture_efficiency").alias("health_score")
    )
    synced = V.synced_rows(spark, sf)
    cases = {
        "record": (record, synced), "synced rows": (record.filter("health_score > 2"), synced),
        "no rows": (None, synced.filter("offset < 0")), "nothing readable": (None, None),
        "record without score": (record.withColumn("health_score", F.lit(None).cast("double")), synced),
    }
    out = None
    for name, (rec, rows) in cases.items():
        one = G.health_gate(rec, rows).select(F.lit(name).alias("source"), r6("health_score"), "status")
        out = one if out is None else out.unionByName(one)
    return out


PSEUDO = "0.4*semantic_risk + 0.3*proxy_score + 0.15*(semantic_risk*amount_deviation)"


def pseudo_scored(spark, sf):
    s = S.pseudo_score(F.col("semantic_risk"), F.col("proxy_score"), F.col("amount_deviation"))
    return V.txn(spark, sf).withColumn("score", s)


def registry(spark, sf):
    """Model versions, one per nation: the newest is the challenger, the one before it the champion."""
    k = F.col("n_nationkey")
    newest = table(spark, sf, "nation").agg(F.max("n_nationkey")).scalar()
    status = F.when(k == newest, "challenger").when(k == newest - 1, "champion").otherwise("retired")
    return table(spark, sf, "nation").select(
        F.concat(F.lit("v"), k.cast("string")).alias("version"), status.alias("status"), k.alias("created")
    )


REG = """r AS (SELECT 'v'||n_nationkey AS version, n_nationkey AS created, (SELECT max(n_nationkey) FROM nation) AS top FROM nation)"""


@query("champion_challenger", with_views("txn", f""", scored AS (SELECT *, {PSEUDO} AS score FROM txn),
m AS ({prf_sql(counts_sql('score > 0.5'))}), a AS ({auc_sql()}), {REG},
g AS (SELECT 'evaluated' AS kase, CASE WHEN bool_and(value >= lim) THEN 'PASS' ELSE 'FAIL' END AS gate
  FROM ({long_sql('(SELECT * FROM m, a)')}) JOIN {LIMITS} USING (metric)
  UNION ALL SELECT 'failed', 'FAIL' UNION ALL SELECT 'first model failed', 'FAIL')
SELECT kase AS "case", version, created, CASE
    WHEN gate='PASS' THEN CASE WHEN created=top THEN 'champion' ELSE 'retired' END
    WHEN kase='first model failed' THEN CASE WHEN created=top THEN 'challenger' ELSE 'retired' END
    WHEN created=top-1 THEN 'champion' ELSE 'retired' END AS status,
  CASE WHEN gate='PASS' THEN 'PROMOTED' WHEN kase='first model failed' THEN 'NO_CHAMPION_TO_RESTORE' ELSE 'RESTORED' END AS action
FROM g, r"""))
def champion_challenger(spark, sf):
    reg = registry(spark, sf)
    gate = G.gate_result(M.evaluate(pseudo_scored(spark, sf))).scalar()
    first = reg.withColumn("status", F.when(F.col("status") == "champion", "retired").otherwise(F.col("status")))
    cases = {"evaluated": (reg, gate), "failed": (reg, "FAIL"), "first model failed": (first, "FAIL")}
    out = None
    for name, (rows, g) in cases.items():
        one = G.promote(rows, g).withColumn("case", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("gated_inference", with_views("txn infra", f""", scored AS (SELECT *, {PSEUDO} AS score FROM txn),
m AS ({prf_sql(counts_sql('score > 0.5'))}), a AS ({auc_sql()}),
g AS (SELECT bool_and(value >= lim) AS ok FROM ({long_sql('(SELECT * FROM m, a)')}) JOIN {LIMITS} USING (metric)),
h AS (SELECT l AS health_limit, avg(architecture_efficiency) >= l AS ok FROM infra, (VALUES (0.35::double), (0.2::double)) v(l)
  WHERE cs_auth_status IS NOT NULL GROUP BY l)
SELECT health_limit, txn_id, round(pair_score, 6) AS score, CASE WHEN pair_score > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision
FROM ({PAIR_SQL}), h WHERE (SELECT ok FROM g) AND h.ok"""))
def gated_inference(spark, sf):
    """One stored feature table serves the evaluation, the gate and the scoring under both limits."""
    rows = materialize(V.txn(spark, sf), "features")
    pseudo = rows.withColumn(
        "score", S.pseudo_score(F.col("semantic_risk"), F.col("proxy_score"), F.col("amount_deviation"))
    )
    gate = G.gate_result(M.evaluate(pseudo))
    record = V.infra(spark, sf).filter("cs_auth_status IS NOT NULL").agg(
        F.avg("architecture_efficiency").alias("health_score")
    )
    passed = G.gated_by_limits(rows, gate, record, [G.HEALTH_LIMIT, 0.2])
    return get_engine("pair_model")(passed).select("health_limit", "txn_id", r6("score"), "decision")


@query("coef_bound_check", f"""SELECT 'published' AS model_id, 2::bigint AS n_nodes, round({max(abs(c) for n in [*FRAUD.nodes, FRAUD.master] for c in n.coeffs)!r}e0, 6) AS max_coef,
  false AS coef_ok, count(*) AS n_scored, sum(CASE WHEN s = 1 THEN 1 ELSE 0 END)::bigint AS n_clipped FROM
  (WITH txn_b AS ({V.VIEW_SQL['txn_b']}), txn_f AS ({V.VIEW_SQL['txn_f']}), txn AS ({V.VIEW_SQL['txn']}) SELECT pair_score AS s FROM ({PAIR_SQL}))""")
def coef_bound_check(spark, sf):
    """Bounds of the published coefficients, and how many scores they drive to the upper limit."""
    checks = D.size_and_bounds(FRAUD.to_table(spark, "published"))
    scored = get_engine("pair_model")(V.txn(spark, sf)).agg(
        F.count("*").alias("n_scored"), F.count_if(F.col("score") == 1).alias("n_clipped")
    )
    one = checks.select(F.struct("model_id", "n_nodes", r6("max_coef"), "coef_ok").alias("c")).scalar()
    return scored.select(one.alias("c"), "n_scored", "n_clipped").select("c.*", "n_scored", "n_clipped")


@query("model_comparison_table", with_views("txn", f"""
, v AS ({' UNION ALL '.join(f"SELECT '{n}' AS model, ({e})::double AS score, is_fraud FROM txn" for n, e in (
    ('rule', '0.5*semantic_risk + 0.3*proxy_score + 0.2*least(1.0, velocity_1h/20)'), ('pseudo', PSEUDO), ('semantic', 'semantic_risk')))}),
m AS ({prf_sql(counts_sql('score > 0.5', extra='model,', source='v', group='GROUP BY model'))}), a AS ({auc_sql(source='v', group='model')})
SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc,
  round(f1, 6) >= 0.45 AND round(precision, 6) >= 0.5 AND round(recall, 6) >= 0.4 AND round(auc_roc, 6) >= 0.78 AS gate FROM m JOIN a USING (model)"""))
def model_comparison_table(spark, sf):
    """Metric documents of two layouts, nested and flat, brought into one table."""
    from riskloom.sources.documents import metric_documents, read_metric_documents

    rows = V.txn(spark, sf)
    scores = F.array(
        F.struct(F.lit("rule").alias("model"), S.rule_score(F.col("semantic_risk"), F.col("velocity_1h"), F.col("proxy_score")).alias("score")),
        F.struct(F.lit("pseudo").alias("model"), S.pseudo_score(F.col("semantic_risk"), F.col("proxy_score"), F.col("amount_deviation")).alias("score")),
        F.struct(F.lit("semantic").alias("model"), F.col("semantic_risk").alias("score")),
    )
    long = rows.select("is_fraud", F.explode(scores).alias("s")).select("is_fraud", "s.*")
    metrics = M.evaluate(long, by=["model"]).select("model", *[r6(c) for c in METRIC_COLS])
    return read_metric_documents(metric_documents(metrics, nested=F.col("model") == "rule"))
