"""Score regressions, run failures, linter issues and task concurrency."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import concurrency as C
from riskloom.operators import history as H
from riskloom.plans import views as V
from riskloom.plans.scalar import r6
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.sources.tables import table

ISSUE_ORDER = ["l_orderkey", "l_partkey", "line_number", "l_quantity", "l_extendedprice"]


def latest_first():
    return [F.col("check_timestamp").desc(), *[F.col(c) for c in ISSUE_ORDER]]


NTH = """SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY check_timestamp DESC, l_orderkey, l_partkey, line_number,
  l_quantity, l_extendedprice) AS rn, dense_rank() OVER (PARTITION BY dag_id ORDER BY check_timestamp DESC) AS dr FROM issues"""


@query("nth_latest_score", with_views("issues", f"""
SELECT dag_id, check_timestamp, round(overall_score, 6) AS overall_score, issue_type, message, line_number FROM ({NTH}) WHERE rn = 2"""))
def nth_latest_score(spark, sf):
    df = H.nth_latest(V.issues(spark, sf), "dag_id", latest_first(), 2)
    return df.select("dag_id", "check_timestamp", r6("overall_score"), "issue_type", "message", "line_number")


@query("nth_latest_check", with_views("issues", f"""
SELECT dag_id, check_timestamp, round(overall_score, 6) AS overall_score, message FROM ({NTH}) WHERE dr = 2"""))
def nth_latest_check(spark, sf):
    df = H.nth_latest(V.issues(spark, sf), "dag_id", [F.col("check_timestamp").desc()], 2, dense=True)
    return df.select("dag_id", "check_timestamp", r6("overall_score"), "message")


def current_and_previous(spark, sf):
    issues = V.issues(spark, sf)
    now = H.nth_latest(issues, "dag_id", latest_first(), 1).select("dag_id", F.col("overall_score").alias("score"))
    old = H.nth_latest(issues, "dag_id", latest_first(), 2).select(
        "dag_id",
        F.when(F.col("l_partkey") % 10 == 0, "n/a").when(F.col("l_partkey") % 10 == 1, None)
        .otherwise(F.col("overall_score").cast("string")).alias("score"),
    )
    return now, old


@query("score_regression", with_views("issues", f""", n AS ({NTH}),
cur AS (SELECT dag_id, overall_score AS score FROM n WHERE rn = 1),
prev AS (SELECT dag_id, CASE WHEN l_partkey%10 > 1 THEN overall_score END AS score FROM n WHERE rn = 2)
SELECT cur.dag_id, round(cur.score, 6) AS current_score, round(coalesce(prev.score, 10), 6) AS previous_score,
  round(cur.score - coalesce(prev.score, 10), 6) AS difference
FROM cur LEFT JOIN prev USING (dag_id) WHERE cur.score < coalesce(prev.score, 10) - 0.1"""))
def score_regression(spark, sf):
    df = H.score_regressions(*current_and_previous(spark, sf))
    return df.select("dag_id", r6("current_score"), r6("previous_score"), r6("difference"))


STATES = """
two AS (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY execution_date DESC, run_id DESC) AS rn FROM runs),
pairs AS (SELECT a.dag_id, a.state AS s1, coalesce(b.state, 'missing') AS s2, a.run_id AS r1, b.run_id AS r2
  FROM two a LEFT JOIN two b ON a.dag_id = b.dag_id AND b.rn = 2 WHERE a.rn = 1),
kinds AS (SELECT *, CASE WHEN s1='failed' AND s2='failed' THEN 'Recurring Failure' WHEN s1='failed' THEN 'New Failure'
  WHEN s1='success' AND s2='failed' THEN 'Resolved Failure' END AS failure_type FROM pairs),
states AS (SELECT k.dag_id, r.run_id, CASE WHEN failure_type='Resolved Failure' THEN 'RESOLVED' ELSE 'UNRESOLVED' END AS status_type,
  failure_type, r.execution_date, r.end_date FROM kinds k JOIN runs r
  ON r.run_id = CASE WHEN failure_type='Resolved Failure' THEN r2 ELSE r1 END WHERE failure_type IS NOT NULL AND r.has_error_lines)
"""


@query("last_two_runs_status", with_views("runs", f", {STATES} SELECT * FROM states"))
def last_two_runs_status(spark, sf):
    return H.run_states(V.runs(spark, sf))


@query("failure_totals", with_views("runs", f""", {STATES} SELECT count(*) AS total,
  count(*) FILTER (status_type='UNRESOLVED') AS unresolved, count(*) FILTER (status_type='RESOLVED') AS resolved FROM states"""))
def failure_totals(spark, sf):
    return H.failure_totals(H.run_states(V.runs(spark, sf)))


@query("failures_latest_first", with_views("runs", f""", {STATES}
SELECT dag_id, run_id, status_type, ended, row_number() OVER (ORDER BY ended DESC, dag_id DESC, run_id DESC) = 1 AS is_latest
FROM (SELECT *, coalesce(end_date, execution_date) AS ended FROM states) ORDER BY ended DESC, dag_id DESC"""))
def failures_latest_first(spark, sf):
    df = H.failures_latest_first(H.run_states(V.runs(spark, sf)))
    return df.select("dag_id", "run_id", "status_type", "ended", "is_latest")


@query("runs_with_pause_flag", with_views("runs", f""", {STATES}
SELECT s.dag_id, s.run_id, s.failure_type, p.is_paused FROM states s LEFT JOIN
  (SELECT 'dag_'||c_custkey AS dag_id, c_acctbal < 0 AS is_paused FROM customer WHERE c_mktsegment <> 'BUILDING') p USING (dag_id)"""))
def runs_with_pause_flag(spark, sf):
    flags = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.concat(F.lit("dag_"), F.col("c_custkey").cast("string")).alias("dag_id"),
        (F.col("c_acctbal") < 0).alias("is_paused"),
    )
    states = H.run_states(V.runs(spark, sf)).select("dag_id", "run_id", "failure_type")
    return states.join(flags, "dag_id", "left")


def dag_scores(spark, sf):
    """Latest score per pipeline; some pipelines have none."""
    now = H.nth_latest(V.issues(spark, sf), "dag_id", latest_first(), 1)
    return now.select("dag_id", F.when(F.col("l_partkey") % 7 != 0, F.col("overall_score")).alias("score"))


SCORES = f"""s AS (SELECT dag_id, CASE WHEN l_partkey%7 <> 0 THEN overall_score END AS score FROM ({NTH}) WHERE rn = 1)"""


@query("lint_overall_score", with_views("issues", f""", {SCORES} SELECT round(CASE WHEN count(*)=0 THEN 10.0::double
  ELSE coalesce(sum(score), 0)/count(*) END, 6) AS overall_score, count(*) AS n_dags FROM s"""))
def lint_overall_score(spark, sf):
    return H.overall_score(dag_scores(spark, sf)).select(r6("overall_score"), "n_dags")


@query("scores_low_to_high", with_views("issues", f""", {SCORES} SELECT dag_id, round(score, 6) AS score FROM s
WHERE score IS NOT NULL ORDER BY score, dag_id"""))
def scores_low_to_high(spark, sf):
    return dag_scores(spark, sf).filter("score IS NOT NULL").select("dag_id", r6("score")).orderBy("score", "dag_id")


@query("issue_severity_counts", with_views("issues", """SELECT count(*) FILTER (issue_type IN ('E','F')) AS n_errors,
  count(*) FILTER (issue_type='W') AS n_warnings FROM issues"""))
def issue_severity_counts(spark, sf):
    return H.severity_counts(V.issues(spark, sf))


@query("issues_top10_per_dag", with_views("issues", """
SELECT dag_id, n_issues, string_agg(symbol_code||' ('||issue_type||') | Line '||line_number||': '||message, chr(10) ORDER BY rn)
  ||CASE WHEN n_issues > 10 THEN chr(10)||'...and '||(n_issues-10)||' more violations.' ELSE '' END AS report
FROM (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY l_orderkey, l_partkey, line_number, l_quantity, l_extendedprice) AS rn,
  count(*) OVER (PARTITION BY dag_id) AS n_issues FROM issues) WHERE rn <= 10 GROUP BY dag_id, n_issues"""))
def issues_top10_per_dag(spark, sf):
    return H.top_issues(V.issues(spark, sf), ISSUE_ORDER)


@query("broken_files_summary", """
SELECT count(*) AS n_errors, count(DISTINCT nullif(url, '')) AS n_files, (SELECT string_agg(u, chr(10) ORDER BY u) FROM
  (SELECT DISTINCT url AS u FROM pages WHERE url <> '' ORDER BY u LIMIT 5)) AS first_files FROM pages""")
def broken_files_summary(spark, sf):
    return H.broken_files(table(spark, sf, "pages"), "url")


@query("avg_history_score", with_views("issues", f""", {SCORES}
SELECT round(coalesce(sum(coalesce(score, 0))/nullif(count(*), 0), 0), 6) AS avg_score, count(*) AS n_issues FROM s"""))
def avg_history_score(spark, sf):
    df = dag_scores(spark, sf).withColumnRenamed("score", "overall_score")
    return H.average_history_score(df).select(r6("avg_score"), "n_issues")


@query("table_retention", with_views("issues", """
SELECT dag_id, check_timestamp, message FROM issues WHERE NOT (check_timestamp >= m - INTERVAL 90 DAY AND check_timestamp <= m - INTERVAL 30 DAY)
""".replace("FROM issues", "FROM issues, (SELECT max(l_shipdate) AS m FROM lineitem) g")))
def table_retention(spark, sf):
    from riskloom.sources.store import outside_retention

    issues = V.issues(spark, sf)
    now = issues.agg(F.max("check_timestamp")).scalar()
    return outside_retention(issues, "check_timestamp", now).select("dag_id", "check_timestamp", "message")


MINUTES = """
pts AS (SELECT dag_id, unnest(generate_series(date_trunc('minute', start_date), end_date, INTERVAL 1 MINUTE)) AS minute
  FROM task_spans WHERE start_date IS NOT NULL AND end_date IS NOT NULL),
top AS (SELECT dag_id, count(*) AS c FROM pts GROUP BY dag_id ORDER BY c DESC, dag_id LIMIT 10),
grp AS (SELECT minute, CASE WHEN dag_id IN (SELECT dag_id FROM top) THEN dag_id ELSE 'others' END AS dag_group FROM pts),
loads AS (SELECT minute, dag_group, count(*) AS load FROM grp GROUP BY minute, dag_group)"""


@query("topn_membership", with_views("task_spans", f""", {MINUTES}
SELECT dag_id, start_date, CASE WHEN dag_id IN (SELECT dag_id FROM top) THEN dag_id ELSE 'others' END AS dag_group FROM task_spans"""))
def topn_membership(spark, sf):
    spans = V.task_spans(spark, sf)
    top = C.top_members(C.dag_points(spans), "dag_id", "points", 10)
    return C.with_group(spans, "dag_id", top).select("dag_id", "start_date", "dag_group")


@query("concurrency_by_minute", with_views("task_spans", f", {MINUTES} SELECT minute, dag_group, load FROM loads"))
def concurrency_by_minute(spark, sf):
    return C.by_minute(V.task_spans(spark, sf))


@query("concurrency_pivot", with_views("task_spans", f""", {MINUTES}
, t AS (SELECT dag_group, count(*) AS total FROM grp GROUP BY dag_group)
SELECT m.minute, list(coalesce(l.load, 0) ORDER BY t.total DESC, t.dag_group) AS loads
FROM (SELECT DISTINCT minute FROM grp) m CROSS JOIN t LEFT JOIN loads l ON l.minute = m.minute AND l.dag_group = t.dag_group GROUP BY m.minute"""))
def concurrency_pivot(spark, sf):
    """The loads of each minute in the order of the pivoted columns, heaviest group first."""
    wide = C.pivot_minutes(C.by_minute(V.task_spans(spark, sf)))
    return wide.select("minute", F.array(*[F.col(f"`{c}`") for c in wide.columns if c != "minute"]).alias("loads"))


@query("concurrency_peak", with_views("task_spans", f""", {MINUTES}
SELECT load AS peak_load, minute AS peak_at, load > 16 AS is_over_limit FROM
  (SELECT minute, count(*) AS load FROM grp GROUP BY minute) ORDER BY load DESC, minute LIMIT 1"""))
def concurrency_peak(spark, sf):
    return C.peak(C.by_minute(V.task_spans(spark, sf)))


@query("group_contribution", with_views("task_spans", f""", {MINUTES}
SELECT dag_group, count(*) AS points, round(100.0::double*count(*)/(SELECT count(*) FROM grp), 6) AS percent FROM grp GROUP BY dag_group"""))
def group_contribution(spark, sf):
    return C.contribution(C.by_minute(V.task_spans(spark, sf))).select("dag_group", "points", r6("percent"))
