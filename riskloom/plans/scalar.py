"""Projections, filters and scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.functions import text as X
from riskloom.operators import scaling, selection
from riskloom.plans import views as V
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.sources.tables import table

INFRA_COLS = ["amazon_api_latency", "cs_auth_status", "system_cpu_load"]


def r6(name, expr=None):
    return F.round(F.col(name) if expr is None else expr, 6).alias(name)


def r10(name, expr=None):
    """Finer rounding for the health view: its values often end in an exact half at seven digits."""
    return F.round(F.col(name) if expr is None else expr, 10).alias(name)


def r12(name, expr):
    return F.round(expr, 12).alias(name)


@query("feat_scale_const", with_views("infra", """
SELECT order_id, round(amazon_api_latency/2000, 10) AS x1, cs_auth_status AS x2, round(system_cpu_load/100, 6) AS x3
FROM infra"""))
def feat_scale_const(spark, sf):
    return V.infra(spark, sf).select(
        "order_id", r10("x1", F.col("amazon_api_latency") / F.lit(2000.0)), F.col("cs_auth_status").alias("x2"),
        r6("x3", F.col("system_cpu_load") / F.lit(100.0)),
    )


@query("feat_fill_zero", with_views("infra", """
SELECT order_id, round(amazon_api_latency, 10) AS amazon_api_latency, coalesce(cs_auth_status, 0) AS cs_auth_status,
  round(coalesce(architecture_efficiency, 0), 10) AS architecture_efficiency FROM infra"""))
def feat_fill_zero(spark, sf):
    return V.infra(spark, sf).na.fill(0.0).select(
        "order_id", r10("amazon_api_latency"), "cs_auth_status", r10("architecture_efficiency")
    )


@query("filter_missing_auth", with_views("infra", """
SELECT order_id, cs_auth_status, round(architecture_efficiency, 10) AS architecture_efficiency FROM infra
WHERE cs_auth_status IS NOT NULL AND trim(cs_auth_status::varchar) <> ''"""))
def filter_missing_auth(spark, sf):
    df = V.infra(spark, sf).filter(F.trim(F.col("cs_auth_status").cast("string")) != "")
    return df.select("order_id", "cs_auth_status", r10("architecture_efficiency"))


@query("field_first_of", with_views("raw_ieee", """
SELECT o_orderkey, coalesce(nullif("DeviceInfo", ''), nullif("TransactionAmt", '')) AS first_value,
  coalesce(nullif("P_emaildomain", ''), nullif("R_emaildomain", '')) AS domain FROM raw_ieee"""))
def field_first_of(spark, sf):
    df = V.raw_ieee(spark, sf)
    return df.select(
        "o_orderkey", S.first_of(df, S.FIELD_CANDIDATES["semantic_risk"]).alias("first_value"),
        S.first_of(df, ["P_emaildomain", "R_emaildomain"]).alias("domain"),
    )


NUM = "coalesce(try_cast(raw AS double), 0)"


@query("to_number", with_views("bad_numbers", f"""
SELECT p_partkey, raw, isnan({NUM}) AS is_nan, CASE WHEN NOT isnan({NUM}) THEN {NUM} END AS number FROM bad_numbers"""))
def to_number(spark, sf):
    x = S.to_number(F.col("raw"))
    return V.bad_numbers(spark, sf).select(
        "p_partkey", "raw", F.isnan(x).alias("is_nan"), F.when(~F.isnan(x), x).alias("number")
    )


@query("to_unit_interval", with_views("bad_numbers", f"""
SELECT p_partkey, greatest(0.0::double, least(1.0::double, {NUM})) AS unit FROM bad_numbers"""))
def to_unit_interval(spark, sf):
    return V.bad_numbers(spark, sf).select("p_partkey", S.to_unit_interval(F.col("raw")).alias("unit"))


@query("to_binary", with_views("bad_numbers", f"""
SELECT p_partkey, CASE WHEN NOT isnan({NUM}) AND {NUM} > 0 THEN 1 ELSE 0 END AS flag FROM bad_numbers"""))
def to_binary(spark, sf):
    return V.bad_numbers(spark, sf).select("p_partkey", S.to_binary(F.col("raw")).alias("flag"))


NORMALIZED = """
SELECT o_orderkey, greatest(0.0::double, least(1.0::double, coalesce(try_cast(coalesce(nullif("DeviceInfo", ''),
    nullif("TransactionAmt", '')) AS double), 0))) AS semantic_risk,
  coalesce(try_cast(nullif("TransactionDT", '') AS double), 0) AS velocity_1h, 0.0::double AS proxy_score,
  coalesce(try_cast(nullif("TransactionAmt", '') AS double), 0) AS amount_deviation,
  CASE WHEN try_cast(nullif("isFraud", '') AS double) > 0 THEN 1 ELSE 0 END AS is_fraud FROM raw_ieee"""


@query("normalize_benchmark", with_views("raw_ieee", NORMALIZED))
def normalize_benchmark(spark, sf):
    return S.normalize_benchmark(V.raw_ieee(spark, sf), keep=["o_orderkey"])


AMT0 = """coalesce(try_cast(coalesce(nullif("TransactionAmt", ''), '0') AS double), 0)"""
RISKY = "('gmail.com', 'yahoo.com', 'hotmail.com', 'anonymous.com', '')"
IEEE_SQL = {
    "ieee_semantic_risk": f"""round(least(1.0, 0.2::double
      + CASE WHEN lower(coalesce("DeviceInfo", '')) IN ('', 'nan') THEN 0.2::double ELSE 0 END
      + CASE WHEN lower(coalesce(card4, '')) IN ('visa', 'mastercard') AND lower(coalesce(card6, '')) = 'debit'
          THEN 0.15::double ELSE 0 END
      + CASE WHEN lower(coalesce("DeviceType", '')) = 'mobile' THEN 0.1::double ELSE 0 END
      + CASE WHEN {AMT0} > 300 THEN 0.2::double WHEN {AMT0} > 100 THEN 0.05::double ELSE 0 END), 6)""",
    "ieee_velocity": """round(least(1.0,
      coalesce(try_cast(coalesce(nullif("TransactionDT", ''), '0') AS double), 0) / 15811131.0), 6)""",
    "ieee_proxy_score": f"""round(least(1.0, 0.1::double
      + CASE WHEN trim(lower(coalesce("P_emaildomain", ''))) IN {RISKY} THEN 0.3::double ELSE 0 END
      + CASE WHEN coalesce(try_cast(coalesce(nullif(addr1, ''), '0') AS double), 0) = 0 THEN 0.25::double ELSE 0 END
      + CASE WHEN trim(lower(coalesce("R_emaildomain", ''))) IN {RISKY} THEN 0.1::double ELSE 0 END), 6)""",
    "ieee_amount_dev": f"round(least(1.0, {AMT0} / 500.0), 6)",
}
IEEE_RULES = {
    "ieee_semantic_risk": S.ieee_semantic_risk, "ieee_velocity": S.ieee_velocity,
    "ieee_proxy_score": S.ieee_proxy_score, "ieee_amount_dev": S.ieee_amount_dev,
}


def _register_ieee(name):
    @query(name, with_views("raw_ieee", f"SELECT o_orderkey, {IEEE_SQL[name]} AS {name} FROM raw_ieee"))
    def run(spark, sf):
        return S.with_parsed(V.raw_ieee(spark, sf)).select("o_orderkey", IEEE_RULES[name]().alias(name))


for _name in IEEE_SQL:
    _register_ieee(_name)

PREPARED = f"""SELECT {IEEE_SQL['ieee_semantic_risk']} AS semantic_risk, {IEEE_SQL['ieee_velocity']} AS velocity_1h,
  {IEEE_SQL['ieee_proxy_score']} AS proxy_score, {IEEE_SQL['ieee_amount_dev']} AS amount_deviation,
  CASE WHEN try_cast("isFraud" AS double) > 0 THEN 1 ELSE 0 END AS is_fraud, o_orderkey FROM raw_ieee"""


@query("prepare_ieee_cis", with_views("raw_ieee", PREPARED))
def prepare_ieee_cis(spark, sf):
    return S.prepare_ieee_cis(V.raw_ieee(spark, sf), keep=["o_orderkey"])


@query("prepare_ieee_cis_summary", with_views("raw_ieee", f"""
SELECT count(*) AS row_count, sum(is_fraud)::bigint AS fraud_count, round(avg(is_fraud), 6) AS fraud_rate FROM ({PREPARED})"""))
def prepare_ieee_cis_summary(spark, sf):
    return S.prepare_ieee_cis(V.raw_ieee(spark, sf)).agg(
        F.count("*").alias("row_count"), F.sum("is_fraud").alias("fraud_count"), r6("fraud_rate", F.avg("is_fraud"))
    )


@query("impute_median", with_views("infra", """
SELECT order_id, coalesce(cs_auth_status, (SELECT median(cs_auth_status) FROM infra)) AS cs_auth_status,
  round(coalesce(architecture_efficiency, (SELECT median(architecture_efficiency) FROM infra)), 10)
    AS architecture_efficiency, round(amazon_api_latency, 10) AS amazon_api_latency FROM infra"""))
def impute_median(spark, sf):
    df = V.infra(spark, sf)
    cols = [*INFRA_COLS, "architecture_efficiency"]
    return selection.impute_median(df, cols).select(
        "order_id", "cs_auth_status", r10("architecture_efficiency"), r10("amazon_api_latency")
    )


def minmax_frame(spark, sf):
    """Feature columns plus one constant column."""
    return V.txn(spark, sf).select("txn_id", *V.FEATURES, F.lit(7.0).alias("constant"))


MM_COLS = [*V.FEATURES, "constant"]
MM_VIEW = "SELECT txn_id, semantic_risk, velocity_1h, proxy_score, amount_deviation, 7.0::double AS constant FROM txn"


def minmax_sql(cell):
    cells = ",\n  ".join(
        f"round({cell.format(c=c, lo=f'min({c}) OVER ()', hi=f'max({c}) OVER ()')}, 6) AS {c}" for c in MM_COLS
    )
    return with_views("txn", f"SELECT txn_id, {cells} FROM ({MM_VIEW})")


@query("minmax_guarded", minmax_sql("CASE WHEN {hi} > {lo} THEN ({c} - {lo}) / ({hi} - {lo}) ELSE 0 END"))
def minmax_guarded(spark, sf):
    df = minmax_frame(spark, sf)
    df = scaling.apply_minmax(df, scaling.fit_minmax(df, MM_COLS), "zero")
    return df.select("txn_id", *[r6(c) for c in MM_COLS])


@query("minmax_eps", minmax_sql("({c} - {lo}) / ({hi} - {lo} + 1e-8)"))
def minmax_eps(spark, sf):
    df = minmax_frame(spark, sf)
    df = scaling.apply_minmax(df, scaling.fit_minmax(df, MM_COLS), "eps")
    return df.select("txn_id", *[r6(c) for c in MM_COLS])


@query("minmax_skip_const", minmax_sql("CASE WHEN {hi} > {lo} THEN ({c} - {lo}) / ({hi} - {lo}) ELSE {c} END"))
def minmax_skip_const(spark, sf):
    df = minmax_frame(spark, sf)
    df = scaling.apply_minmax(df, scaling.fit_minmax(df, MM_COLS), "keep")
    return df.select("txn_id", *[r6(c) for c in MM_COLS])


ZSCORE = ",\n  ".join(
    f"round(({c} - (SELECT avg({c}) FROM p)) / ((SELECT stddev_pop({c}) FROM p) + {{eps}}), 6) AS {c}"
    for c in V.FEATURES
)


@query("zscore", with_views("txn", f", p AS (SELECT * FROM txn) SELECT txn_id, {ZSCORE.format(eps='1e-8')} FROM txn"))
def zscore(spark, sf):
    df = V.txn(spark, sf)
    df = scaling.apply_zscore(df, scaling.fit_zscore(df, V.FEATURES))
    return df.select("txn_id", *[r6(c) for c in V.FEATURES])


@query("apply_norm_params", with_views("txn", f""", p AS (SELECT * FROM txn WHERE epoch = 'stable')
SELECT txn_id, {ZSCORE.format(eps='1e-8 + 1e-8')} FROM txn WHERE epoch = 'drift'"""))
def apply_norm_params(spark, sf):
    df = V.txn(spark, sf)
    params = scaling.fit_zscore(df.filter("epoch = 'stable'"), V.FEATURES)
    out = scaling.apply_zscore(df.filter("epoch = 'drift'"), params, extra_eps=scaling.EPS)
    return out.select("txn_id", *[r6(c) for c in V.FEATURES])


MD5 = "(('0x'||substr(md5({c}),1,8))::BIGINT % 100)/100.0::double"


@query("semantic_hash_risk", f"""
SELECT doc_id::varchar AS order_id, round({MD5.format(c="coalesce(text, '')")}, 2) AS semantic_risk, 'hash' AS engine
FROM documents""")
def semantic_hash_risk(spark, sf):
    return table(spark, sf, "documents").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("unknown")).alias("order_id"),
        F.round(S.md5_percent(F.coalesce(F.col("text"), F.lit(""))), 2).alias("semantic_risk"),
        F.lit("hash").alias("engine"),
    )


HASH_TEXT = "semantic_risk::varchar||velocity_1h::varchar||proxy_score::varchar||amount_deviation::varchar"


@query("hash_score", with_views("txn", f"""
SELECT txn_id, round({MD5.format(c=HASH_TEXT)}, 2) AS score,
  CASE WHEN round({MD5.format(c=HASH_TEXT)}, 2) > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM txn"""))
def hash_score(spark, sf):
    score = F.round(S.md5_percent(F.concat(*[X.float_text(F.col(c)) for c in V.FEATURES])), 2)
    return V.txn(spark, sf).select("txn_id", score.alias("score"), S.decision(score).alias("decision"))


@query("llm_prompt", with_views("txn", f"""
SELECT doc_id AS id, 'rate' AS kind, '{X.RATE_PROMPT}'||text AS prompt FROM documents
UNION ALL SELECT txn_id, 'score', '{X.SCORE_PROMPT}semantic_risk='||semantic_risk||', velocity_1h='||velocity_1h
  ||', proxy_score='||proxy_score||', amount_deviation='||amount_deviation FROM txn"""))
def llm_prompt(spark, sf):
    rate = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit("rate").alias("kind"), X.rate_prompt(F.col("text")).alias("prompt")
    )
    score = V.txn(spark, sf).select(
        F.col("txn_id").alias("id"), F.lit("score").alias("kind"), X.score_prompt(V.FEATURES).alias("prompt")
    )
    return rate.unionByName(score)


@query("llm_parse_score", with_views("replies", r"""
SELECT conv_id, turn, coalesce(list_filter(list_transform(regexp_split_to_array(replace(reply, ',', ' '), '\s+'),
  lambda t: try_cast(nullif(t, '') AS double)), lambda x: x >= 0 AND x <= 1 AND NOT isnan(x))[1], 0.5) AS score
FROM replies"""))
def llm_parse_score(spark, sf):
    return V.replies(spark, sf).select("conv_id", "turn", X.reply_score(F.col("reply")).alias("score"))


@query("decision_threshold", with_views("scored", """
SELECT txn_id, CASE WHEN score > 0.55 THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM scored"""))
def decision_threshold(spark, sf):
    return V.scored_txn(spark, sf).select("txn_id", S.decision(F.col("score")).alias("decision"))


@query("health_status", with_views("infra", """
SELECT order_id, round(architecture_efficiency, 10) AS score, CASE WHEN architecture_efficiency > 0.75 THEN 'OK'
  WHEN architecture_efficiency > 0.45 THEN 'WARN' ELSE 'CRITICAL' END AS status
FROM infra WHERE architecture_efficiency IS NOT NULL"""))
def health_status(spark, sf):
    e = F.col("architecture_efficiency")
    return V.infra(spark, sf).filter(e.isNotNull()).select(
        "order_id", r10("score", e), S.health_status(e).alias("status")
    )


@query("usage_band", """
SELECT p_partkey, CASE WHEN r >= 0.9 THEN 'CRITICAL' WHEN r >= 0.7 THEN 'WARNING' ELSE 'NORMAL' END AS band
FROM (SELECT p_partkey, CASE WHEN p_partkey%51 > 0 THEN p_size::double/(p_partkey%51) ELSE 0 END AS r FROM part)""")
def usage_band(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", S.usage_band(F.col("p_size"), F.col("p_partkey") % 51).alias("band")
    )


@query("rule_score", with_views("scored", "SELECT txn_id, round(score, 6) AS score FROM scored"))
def rule_score(spark, sf):
    return V.scored_txn(spark, sf).select("txn_id", r6("score"))


@query("weighted_score", with_views("txn", """
SELECT txn_id, round(greatest(0.0, least(1.0, 0.45*semantic_risk + 0.35*proxy_score + 0.15*least(1.0, velocity_1h/20)
  + 0.05*least(1.0, amount_deviation/1000))), 12)::double AS score FROM txn"""))
def weighted_score(spark, sf):
    weights = {"semantic_risk": 0.45, "proxy_score": 0.35, "velocity_1h": 0.15, "amount_deviation": 0.05}
    return V.txn(spark, sf).select(
        "txn_id", r12("score", S.weighted_score(weights, *[F.col(c) for c in V.FEATURES]))
    )


@query("pseudo_score", with_views("txn", """
SELECT txn_id, round(s, 12) AS score, s > 0.55 AS is_fraud
FROM (SELECT txn_id, 0.4*semantic_risk + 0.3*proxy_score + 0.15*(semantic_risk*amount_deviation) AS s FROM txn)"""))
def pseudo_score(spark, sf):
    s = S.pseudo_score(F.col("semantic_risk"), F.col("proxy_score"), F.col("amount_deviation"))
    return V.txn(spark, sf).select("txn_id", r12("score", s), (s > 0.55).alias("is_fraud"))


@query("risk_label_rule", with_views("txn", """
SELECT txn_id, round(greatest(0.0, least(1.0, v)), 12)::double AS risk, CASE WHEN v > 0.55 THEN 1 ELSE 0 END AS label
FROM (SELECT txn_id, 0.4*semantic_risk+0.05*velocity_1h/50+0.3*proxy_score+0.15*semantic_risk*amount_deviation AS v
  FROM txn)"""))
def risk_label_rule(spark, sf):
    v = S.risk_value(*[F.col(c) for c in V.FEATURES])
    return V.txn(spark, sf).select(
        "txn_id", r12("risk", S.clip01(v)), F.when(S.clip01(v) > 0.55, 1).otherwise(0).alias("label")
    )


@query("efficiency_rule", with_views("infra", """
SELECT order_id, round(architecture_efficiency, 10) AS efficiency FROM infra"""))
def efficiency_rule(spark, sf):
    return V.infra(spark, sf).select("order_id", r10("efficiency", F.col("architecture_efficiency")))


@query("parse_iso_ts", """
SELECT event_id, try_cast(coalesce(nullif(a, ''), b) AS timestamp) AS at FROM (SELECT event_id,
  CASE event_id%4 WHEN 0 THEN '' WHEN 1 THEN 'soon' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS a,
  strftime(ts, '%Y-%m-%d') AS b FROM events)""")
def parse_iso_ts(spark, sf):
    e = F.col("event_id")
    a = F.when(e % 4 == 0, "").when(e % 4 == 1, "soon").when(e % 4 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    a = a.otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    texts = table(spark, sf, "events").select("event_id", a.alias("a"), F.date_format("ts", "yyyy-MM-dd").alias("b"))
    return texts.select("event_id", S.iso_timestamp(F.col("a"), F.col("b")).cast("timestamp_ntz").alias("at"))


@query("filter_id_list", with_views("issues", """
SELECT dag_id, message, round(overall_score, 6) AS overall_score FROM issues WHERE dag_id IN ('dag_1', 'dag_2', 'dag_5')"""))
def filter_id_list(spark, sf):
    from riskloom.operators.history import filter_ids

    df = filter_ids(V.issues(spark, sf), "dag_id", ["dag_1", " dag_2", "dag_5 "])
    return df.select("dag_id", "message", r6("overall_score"))


@query("log_url_extract", with_views("task_logs", r"""
SELECT doc_id, nullif(regexp_extract(log, p, 1), '') AS bucket, nullif(regexp_extract(log, p, 2), '') AS account,
  nullif(regexp_extract(log, p, 3), '') AS region, nullif(regexp_extract(log, p, 4), '') AS cluster_id,
  nullif(regexp_extract(log, p, 5), '') AS step_id FROM (SELECT *,
  's3://([a-z-]+-(\d+)-([a-z]{2}-[a-z]+-[1-9]))/emr_logs/(j-[\w\d]+)/steps/(s-[\w\d]+)/' AS p FROM task_logs)"""))
def log_url_extract(spark, sf):
    return V.task_logs(spark, sf).select("doc_id", X.log_link_parts(F.col("log")).alias("p")).select("doc_id", "p.*")


WORDS = "|".join(X.ERROR_WORDS)


@query("log_error_lines", with_views("task_logs", f"""
SELECT doc_id, len(l)::int AS n_lines, array_to_string(l, chr(10)) AS error_text FROM (SELECT doc_id,
  list_filter(string_split(log, chr(10)), lambda x: regexp_matches(lower(x), '{WORDS}')) AS l FROM task_logs)"""))
def log_error_lines(spark, sf):
    df = V.task_logs(spark, sf).select("doc_id", X.error_lines(F.col("log")).alias("l"))
    return df.select("doc_id", F.size("l").alias("n_lines"), F.array_join("l", "\n").alias("error_text"))


HEADER = r"^\d{2}/\d{2}/\d{2}\s\d{2}:\d{2}:\d{2}\sERROR\sClient: Application diagnostics message: User class threw exception:"
NO_BLOCKS_SQL = X.NO_BLOCKS.replace("'", "''")


@query("log_error_blocks", with_views("task_logs", rf""", parts AS (
  SELECT doc_id, unnest(string_split(log, chr(10))) AS line, generate_subscripts(string_split(log, chr(10)), 1) AS no
  FROM task_logs),
marked AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\d{{2}}/\d{{2}}/\d{{2}}\s\d{{2}}:\d{{2}}:\d{{2}}') THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY no) AS block FROM parts),
kept AS (SELECT *, max(regexp_matches(line, '{HEADER}')::int) OVER (PARTITION BY doc_id, block) AS keep FROM marked),
joined AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS t FROM kept WHERE keep = 1 GROUP BY doc_id)
SELECT l.doc_id, coalesce(j.t, '{NO_BLOCKS_SQL}') AS blocks FROM task_logs l LEFT JOIN joined j ON l.doc_id = j.doc_id"""))
def log_error_blocks(spark, sf):
    return V.task_logs(spark, sf).select("doc_id", X.error_blocks(F.col("log")).alias("blocks"))


@query("log_error_block_headers", with_views("task_logs", rf"""
SELECT doc_id, CASE WHEN len(l) > 0 THEN array_to_string(l, chr(10)) ELSE '{NO_BLOCKS_SQL}' END AS blocks
FROM (SELECT doc_id, list_filter(string_split(log, chr(10)), lambda x: regexp_matches(x, '{HEADER}')) AS l
  FROM task_logs)"""))
def log_error_block_headers(spark, sf):
    return V.task_logs(spark, sf).select("doc_id", X.error_blocks(F.col("log"), whole_block=False).alias("blocks"))


@query("lint_json_explode", with_views("lint_outputs", r"""
SELECT p_partkey, upper(substr(coalesce(m->>'type', 'U'), 1, 1)) AS issue_type, coalesce(m->>'symbol', 'unknown') AS symbol,
  coalesce(m->>'message-id', 'N/A') AS symbol_code, coalesce(m->>'message', 'N/A') AS message,
  coalesce((m->>'line')::int, 0) AS line_number
FROM (SELECT p_partkey, unnest(from_json(j, '["JSON"]')) AS m FROM (
  SELECT p_partkey, regexp_extract(output, '(?s)\[.*\]') AS j FROM lint_outputs) WHERE json_valid(j) AND j <> '')"""))
def lint_json_explode(spark, sf):
    return X.explode_lint(V.lint_outputs(spark, sf), "output", ["p_partkey"])


@query("lint_score_extract", with_views("lint_outputs", r"""
SELECT p_partkey, try_cast(nullif(regexp_extract(score_output, 'rated at ([\d.]+)/10', 1), '') AS double) AS score
FROM lint_outputs"""))
def lint_score_extract(spark, sf):
    return V.lint_outputs(spark, sf).select("p_partkey", X.lint_score(F.col("score_output")).alias("score"))


@query("text_truncate", """
SELECT doc_id, CASE WHEN length(text) > 1500 THEN substr(text, 1, 1500)||chr(10)||'... [LOG TRUNCATED] ...' ELSE text END
  AS snippet FROM documents""")
def text_truncate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.snippet(F.col("text")).alias("snippet"))
