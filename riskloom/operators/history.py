"""Quality history: regressions, run states and issue summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import parse_number
from riskloom.operators.joins import last_before

# Baseline of a pipeline without history, and the drop that counts as a regression.
NO_BASELINE = 10.0
REGRESSION_STEP = 0.1


def filter_ids(df: DataFrame, column: str, ids: Sequence[str]) -> DataFrame:
    """Rows whose id is in the list; an empty list keeps all rows."""
    wanted = [i.strip() for i in ids]
    return df.filter(F.col(column).isin(wanted)) if wanted else df


def nth_latest(df: DataFrame, key: str, order: Sequence[Column], n: int = 2, dense: bool = False) -> DataFrame:
    """The n-th row per key in the given order, or with ``dense`` all rows of the n-th distinct order value.

    Spark cuts each key to n ranks before the shuffle, so a busy key does not reach one task whole.
    """
    w = Window.partitionBy(key).orderBy(*order)
    rank = F.dense_rank() if dense else F.row_number()
    return df.withColumn("_rn", rank.over(w)).filter(F.col("_rn") == n).drop("_rn")


def score_regressions(current: DataFrame, previous: DataFrame, step: float = REGRESSION_STEP) -> DataFrame:
    """Pipelines whose score fell by more than ``step`` below the previous one (both: dag_id, score).

    A previous score that is missing or no number is replaced by the highest score.
    """
    before = previous.select("dag_id", parse_number(F.col("score")).alias("_prev")).filter("_prev IS NOT NULL")
    base = F.coalesce(F.col("_prev"), F.lit(NO_BASELINE))
    now = F.col("score").cast("double")
    return current.join(before, "dag_id", "left").filter(now < base - F.lit(step)).select(
        "dag_id", now.alias("current_score"), base.alias("previous_score"), (now - base).alias("difference")
    )


def run_states(runs: DataFrame) -> DataFrame:
    """Failure state per pipeline from its latest two runs; reported runs without error lines are left out."""
    w = Window.partitionBy("dag_id").orderBy(F.col("execution_date").desc(), F.col("run_id").desc())
    two = runs.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    row = F.struct("state", "run_id", "execution_date", "end_date", "has_error_lines")
    latest = two.groupBy("dag_id").agg(
        F.max(F.when(F.col("_rn") == 1, row)).alias("now"), F.max(F.when(F.col("_rn") == 2, row)).alias("before")
    )
    failed, was_failed = F.col("now.state") == "failed", F.coalesce(F.col("before.state") == "failed", F.lit(False))
    kind = (
        F.when(failed & was_failed, "Recurring Failure").when(failed, "New Failure")
        .when((F.col("now.state") == "success") & was_failed, "Resolved Failure")
    )
    picked = F.when(failed, F.col("now")).otherwise(F.col("before"))
    return (
        latest.select("dag_id", kind.alias("failure_type"), picked.alias("r")).filter("failure_type IS NOT NULL")
        .filter("r.has_error_lines")
        .select(
            "dag_id", "r.run_id",
            F.when(F.col("failure_type") == "Resolved Failure", "RESOLVED").otherwise("UNRESOLVED").alias("status_type"),
            "failure_type", "r.execution_date", "r.end_date",
        )
    )


def failures_latest_first(failures: DataFrame) -> DataFrame:
    """Failures by end time, newest first; the newest is flagged. Without an end the execution time counts."""
    at = F.coalesce("end_date", "execution_date", F.lit("1970-01-01").cast("timestamp_ntz"))
    timed = failures.withColumn("ended", at)
    place = F.struct("ended", "dag_id", "run_id")
    top = timed.agg(F.max(place)).scalar()
    return timed.withColumn("is_latest", place == top).orderBy(*[F.col(c).desc() for c in ("ended", "dag_id", "run_id")])


def failure_totals(failures: DataFrame) -> DataFrame:
    open_ = F.col("status_type") == "UNRESOLVED"
    return failures.agg(
        F.count("*").alias("total"), F.count_if(open_).alias("unresolved"),
        (F.count("*") - F.count_if(open_)).alias("resolved"),
    )


def overall_score(scores: DataFrame, empty: float = NO_BASELINE) -> DataFrame:
    """Mean over all analysed pipelines, null scores counting as 0; the highest score when there are none."""
    n = F.count("*")
    mean = F.coalesce(F.try_divide(F.coalesce(F.sum("score"), F.lit(0.0)), n), F.lit(empty))
    return scores.agg(mean.alias("overall_score"), n.alias("n_dags"))


def top_issues(issues: DataFrame, order: Sequence[str], limit: int = 10) -> DataFrame:
    """First ``limit`` formatted issues per pipeline, the number of all issues and a line for the rest."""
    line = F.format_string(
        "%s (%s) | Line %d: %s", F.col("symbol_code"), F.col("issue_type"), F.col("line_number"), F.col("message")
    )
    w = Window.partitionBy("dag_id").orderBy(*order)
    first = issues.withColumn("_line", line).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
    lists = first.groupBy("dag_id").agg(F.sort_array(F.collect_list(F.struct("_rn", "_line"))).alias("_l"))
    counts = issues.groupBy("dag_id").agg(F.count("*").alias("n_issues"))
    more = F.when(
        F.col("n_issues") > limit, F.format_string("\n...and %d more violations.", F.col("n_issues") - limit)
    ).otherwise("")
    text = F.concat(F.array_join(F.col("_l._line"), "\n"), more)
    return counts.join(lists, "dag_id").select("dag_id", "n_issues", text.alias("report"))


def broken_files(errors: DataFrame, file: str, show: int = 5) -> DataFrame:
    """Number of errors and of distinct files, and the first files by name."""
    named = F.when(F.col(file) != "", F.col(file))
    first = errors.select(named.alias("f")).filter("f IS NOT NULL").distinct().orderBy("f").limit(show)
    files = first.agg(F.array_sort(F.collect_list("f")).alias("a")).scalar()
    return errors.agg(F.count("*").alias("n_errors"), F.count_distinct(named).alias("n_files")).withColumn(
        "first_files", F.array_join(files, "\n")
    )


def severity_counts(issues: DataFrame) -> DataFrame:
    return issues.agg(
        F.count_if(F.col("issue_type").isin("E", "F")).alias("n_errors"),
        F.count_if(F.col("issue_type") == "W").alias("n_warnings"),
    )


def average_history_score(issues: DataFrame) -> DataFrame:
    mean = F.try_divide(F.sum(F.coalesce(F.col("overall_score"), F.lit(0.0))), F.count("*"))
    return issues.agg(F.coalesce(mean, F.lit(0.0)).alias("avg_score"), F.count("*").alias("n_issues"))


def with_last_run(issues: DataFrame, runs: DataFrame) -> DataFrame:
    """Issues with result_of_last_run and time_of_last_run: state and end of the last completed run that started before
    the check; 'no_history' without one."""
    completed = runs.filter(F.col("state").isin("success", "failed")).select(
        "dag_id", "execution_date", "run_id", "state", "end_date"
    )
    found = last_before(issues, completed, "dag_id", "check_timestamp", "execution_date", "run_id", "_last")
    return found.withColumns({
        "result_of_last_run": F.coalesce("_last.state", F.lit("no_history")), "time_of_last_run": F.col("_last.end_date"),
    }).drop("_last")
