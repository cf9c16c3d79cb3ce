"""Stored tables: creation, appends, retention, round trips through parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Schema of a linter issue row.
ISSUE_SCHEMA = (
    "dag_id STRING, check_timestamp TIMESTAMP, overall_score DOUBLE, issue_type STRING, symbol STRING, "
    "symbol_code STRING, message STRING, line_number INT, result_of_last_run STRING, time_of_last_run TIMESTAMP"
)


def ensure_table(spark: SparkSession, name: str, schema: str = ISSUE_SCHEMA, location: str | None = None) -> None:
    """Create a table unless it exists; with a location it is an external one."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{place}")


def table_folder(spark: SparkSession, name: str) -> str:
    """Where the files of a table lie; for an external table they stay when the catalog forgets it."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return rows.first().data_type


def append_rows(df: DataFrame, name: str) -> None:
    """Append to a table; a frame without rows adds none."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def outside_retention(
    df: DataFrame, at: str, now: Column | str, older_than_days: int = 30, back_to_days: int = 90
) -> DataFrame:
    """Rows kept by the clean-up that drops what is dated ``back_to_days`` to ``older_than_days`` days before now."""
    end = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    t = F.col(at)
    dropped = (t >= end - F.expr(f"INTERVAL {back_to_days} DAY")) & (t <= end - F.expr(f"INTERVAL {older_than_days} DAY"))
    return df.filter(~dropped)


def unload(df: DataFrame, path: str) -> DataFrame:
    """Write a result as parquet over whatever the folder held, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
