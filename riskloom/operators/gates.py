"""Quality gates and the model registry: decisions as table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.metrics import GATE_THRESHOLDS

# Health scores assumed when no health record can be used, and the least score that lets models run.
HEALTH_DEFAULT = 0.75
HEALTH_WITH_ROWS = 0.8
HEALTH_EMPTY = 0.5
HEALTH_LIMIT = 0.35


def gate_checks(metrics: DataFrame, by: list[str] | None = None, limits: dict[str, float] | None = None) -> DataFrame:
    """One row per (group, metric): value, limit, PASS or FAIL. A metric the frame lacks counts as 0."""
    limits = limits or GATE_THRESHOLDS
    cells = []
    for name, limit in limits.items():
        value = F.coalesce(F.col(name), F.lit(0.0)) if name in metrics.columns else F.lit(0.0)
        cells.append(F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"),
                              F.lit(limit).alias("limit")))
    rows = metrics.select(*(by or []), F.explode(F.array(*cells)).alias("c")).select(*(by or []), "c.*")
    return rows.withColumn("status", F.when(F.col("value") >= F.col("limit"), "PASS").otherwise("FAIL"))


def gate_result(metrics: DataFrame, by: list[str] | None = None, limits: dict[str, float] | None = None) -> DataFrame:
    """PASS when all checks pass; without any metrics row the gate passes too."""
    checks = gate_checks(metrics, by, limits)
    ok = F.coalesce(F.bool_and(F.col("status") == "PASS"), F.lit(True))
    return checks.groupBy(*(by or [])).agg(F.when(ok, "PASS").otherwise("FAIL").alias("gate"))


def health_gate(record: DataFrame | None, synced: DataFrame | None, limit: float = HEALTH_LIMIT) -> DataFrame:
    """ENABLED or DISABLED from the health record (0 or 1 rows), else from the synced table, else the default."""
    if record is not None:
        score = F.when(F.count(F.lit(1)) > 0, F.coalesce(F.max("health_score"), F.lit(HEALTH_DEFAULT)))
        from_record = record.agg(score.alias("health_score"))
    else:
        from_record = None
    if synced is not None:
        rows = synced.agg(F.when(F.count(F.lit(1)) > 0, HEALTH_WITH_ROWS).otherwise(HEALTH_EMPTY).alias("health_score"))
    else:
        rows = None
    base = from_record if from_record is not None else rows
    if base is None:
        spark = SparkSession.active()  # nothing can be read: the default holds
        base = spark.range(1).select(F.lit(HEALTH_DEFAULT).alias("health_score"))
    second = rows.scalar() if from_record is not None and rows is not None else F.lit(HEALTH_DEFAULT)
    value = F.coalesce(F.col("health_score"), second)
    return base.select(value.alias("health_score")).withColumn(
        "status", F.when(F.col("health_score") < limit, "DISABLED").otherwise("ENABLED")
    )


def promote(registry: DataFrame, gate: str | Column) -> DataFrame:
    """Next state of the registry (version, status, created): status is champion, challenger or retired.

    PASS makes the newest challenger the champion and retires the old one. FAIL retires the challenger, so the
    champion stays active; without any champion the challenger stays active as it is.
    """
    g = F.lit(gate) if isinstance(gate, str) else gate
    newest = Window.partitionBy("status").orderBy(F.col("created").desc(), F.col("version").desc())
    ranked = registry.withColumn("_rn", F.row_number().over(newest))
    has_champion = F.lit(1) == F.max(F.when(F.col("status") == "champion", 1).otherwise(0)).over(
        Window.partitionBy(F.lit(0))
    )
    has_challenger = F.lit(1) == F.max(F.when(F.col("status") == "challenger", 1).otherwise(0)).over(
        Window.partitionBy(F.lit(0))
    )
    current_champion = (F.col("status") == "champion") & (F.col("_rn") == 1)
    current_challenger = (F.col("status") == "challenger") & (F.col("_rn") == 1)
    state = (
        F.when(current_challenger & (g == "PASS"), "champion")
        .when(current_challenger & ~has_champion, "challenger")
        .when(current_champion & ((g == "FAIL") | ~has_challenger), "champion")
        .otherwise("retired")
    )
    action = (
        F.when(g == "PASS", "PROMOTED").when(has_champion, "RESTORED").otherwise("NO_CHAMPION_TO_RESTORE")
    )
    return ranked.select("version", "created", state.alias("status"), action.alias("action"))


def gated(df: DataFrame, gate: DataFrame, health: DataFrame) -> DataFrame:
    """All rows, or none when the gate failed or the health check disabled scoring."""
    return df.filter((gate.select("gate").scalar() != "FAIL") & (health.select("status").scalar() != "DISABLED"))


def gated_by_limits(df: DataFrame, gate: DataFrame, record: DataFrame | None, limits: list[float]) -> DataFrame:
    """The rows once for each health limit under which scoring runs (``health_limit``), none when the gate failed.

    The gate and the health score are read once; a limit costs no plan of its own.
    """
    score = health_gate(record, None).select("health_score").scalar()
    kept = F.array(*[F.when(score >= limit, F.lit(float(limit))) for limit in limits])
    rows = df.filter(gate.select("gate").scalar() != "FAIL")
    return rows.withColumn("health_limit", F.explode(kept)).filter("health_limit IS NOT NULL")
