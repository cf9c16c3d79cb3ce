"""Round trips through files and tables."""

from __future__ import annotations

import contextlib
import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.models import documents as D
from riskloom.operators.history import with_last_run
from riskloom.plans import views as V
from riskloom.plans.decisions import FRAUD
from riskloom.plans.scalar import r6
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.session import materialize, scratch_dir
from riskloom.sources import files
from riskloom.sources.store import append_rows, ensure_table, table_folder, unload
from riskloom.sources.tables import table

COLUMNS = [*V.FEATURES, "is_fraud"]
FEATURE_SQL = """SELECT txn_id, round(semantic_risk, 6) AS semantic_risk, round(velocity_1h, 6) AS velocity_1h, round(proxy_score, 6) AS proxy_score,
  round(amount_deviation, 6) AS amount_deviation, is_fraud FROM txn"""


@query("sink_csv", with_views("txn", FEATURE_SQL))
def sink_csv(spark, sf):
    """Features written as CSV in a fixed column order and read back as text."""
    path = scratch_dir(spark, "csv")
    files.write_csv(V.txn(spark, sf), path, ["txn_id", *COLUMNS])
    rows = files.read_csv_strings(spark, path, ["txn_id", *COLUMNS])
    return rows.select(
        F.col("txn_id").cast("bigint").alias("txn_id"), *[r6(c, S.to_number(F.col(c))) for c in V.FEATURES],
        S.to_binary(F.col("is_fraud")).alias("is_fraud"),
    )


@query("src_csv_strings", "SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey, c_mktsegment FROM customer")
def src_csv_strings(spark, sf):
    path, cols = scratch_dir(spark, "csv-strings"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    files.write_csv(table(spark, sf, "customer"), path, cols)
    return files.read_csv_strings(spark, path, cols)


@query("src_csv_inferred", "SELECT c_custkey::int AS c_custkey, c_name, round(c_acctbal, 6) AS c_acctbal FROM customer")
def src_csv_inferred(spark, sf):
    path = scratch_dir(spark, "csv-inferred")
    files.write_csv(table(spark, sf, "customer"), path, ["c_custkey", "c_name", "c_acctbal"])
    return files.read_csv_inferred(spark, path).select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_name", r6("c_acctbal"))


@query("src_chunked", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def src_chunked(spark, sf):
    """A scan in file splits: no chunk loop is needed."""
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("src_jsonl", with_views("txn", FEATURE_SQL))
def src_jsonl(spark, sf):
    """Features written as JSON lines and read back with a schema."""
    path = scratch_dir(spark, "jsonl")
    files.write_jsonl(V.txn(spark, sf).select("txn_id", *COLUMNS), path)
    schema = "txn_id bigint, semantic_risk double, velocity_1h double, proxy_score double, amount_deviation double, is_fraud int"
    return files.read_jsonl(spark, path, schema).select("txn_id", *[r6(c) for c in V.FEATURES], "is_fraud")


@query("sink_jsonl", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders")
def sink_jsonl(spark, sf):
    path = scratch_dir(spark, "jsonl-orders")
    files.write_jsonl(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", r6("o_totalprice")), path)
    return files.read_jsonl(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")


@query("src_json_model", with_views("scaled", "SELECT txn_id, true AS same FROM scaled"))
def src_json_model(spark, sf):
    """A model written as a document, read back, and compared with the original on all rows."""
    path = scratch_dir(spark, "model")
    files.write_document(spark, FRAUD.to_document(), path)
    model = D.PairModel.from_document(files.read_document(spark, path))
    return V.scaled_txn(spark, sf).select("txn_id", (model.score() == FRAUD.score()).alias("same"))


@query("src_zip_csv", """SELECT 'archive-'||c_custkey AS path, 1::bigint AS line, c_custkey::varchar AS c_custkey, c_name, NULL::varchar AS missing FROM customer""")
def src_zip_csv(spark, sf):
    """One archive per customer, every second one plain text; the first CSV member counts."""

    @F.pandas_udf("binary")
    def pack(key: pd.Series, name: pd.Series) -> pd.Series:
        out = []
        for k, n in zip(key, name):
            text = f"c_custkey,c_name\n{k},{n}\n".encode()
            if k % 2:
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w") as archive:
                    archive.writestr("readme.txt", "no data")
                    archive.writestr("rows.CSV", text)
                    archive.writestr("other.csv", "c_custkey,c_name\n-1,none\n")
                text = buffer.getvalue()
            out.append(text)
        return pd.Series(out)

    archives = table(spark, sf, "customer").select(
        F.concat(F.lit("archive-"), F.col("c_custkey").cast("string")).alias("path"), pack("c_custkey", "c_name").alias("content")
    )
    return files.expand_archives(archives, ["c_custkey", "c_name", "missing"])


@query("sink_unload_parquet", with_views("issues", """SELECT dag_id, check_timestamp, round(overall_score, 6) AS overall_score, issue_type FROM issues
WHERE issue_type <> 'C'"""))
def sink_unload_parquet(spark, sf):
    rows = V.issues(spark, sf).filter("issue_type <> 'C'").select("dag_id", "check_timestamp", "overall_score", "issue_type")
    return unload(rows, scratch_dir(spark, "unload")).withColumn("overall_score", F.round("overall_score", 6))


@contextlib.contextmanager
def new_table(spark):
    """An empty issue table in the shared folder; the catalog forgets it at the end."""
    path = scratch_dir(spark, "issues")
    name = "issues_" + path.rsplit("-", 1)[1]
    ensure_table(spark, name, location=path)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("table_ensure", with_views("issues", """SELECT 'dag_id' AS col_name, 'string' AS data_type, count(*) AS n_rows FROM issues WHERE 1=0
UNION ALL SELECT 'overall_score', 'double', 0 UNION ALL SELECT 'line_number', 'int', 0"""))
def table_ensure(spark, sf):
    """Creating a table that exists already changes nothing."""
    with new_table(spark) as name:
        ensure_table(spark, name)
        types = dict(spark.table(name).dtypes)
        stored = unload(spark.table(name), scratch_dir(spark, "ensured"))
    rows = [F.struct(F.lit(c).alias("col_name"), F.lit(types[c]).alias("data_type")) for c in ("dag_id", "overall_score", "line_number")]
    return stored.agg(F.count("*").alias("n_rows")).select("n_rows", F.explode(F.array(*rows)).alias("c")).select("c.*", "n_rows")


@query("table_append_batches", with_views("issues runs", """SELECT i.dag_id, check_timestamp, round(overall_score, 6) AS overall_score, issue_type, symbol,
  symbol_code, message, line_number, coalesce(state, 'no_history') AS result_of_last_run, end_date AS time_of_last_run
FROM (SELECT *, row_number() OVER () AS row FROM issues) i LEFT JOIN runs r
  ON r.dag_id = i.dag_id AND r.state IN ('success', 'failed') AND r.execution_date <= i.check_timestamp
QUALIFY row_number() OVER (PARTITION BY i.row ORDER BY r.execution_date DESC NULLS LAST, r.run_id DESC) = 1"""))
def table_append_batches(spark, sf):
    """Issues with the last completed run before their check, appended in batches, one of them empty."""
    rows = with_last_run(V.issues(spark, sf), V.runs(spark, sf)).withColumns({
        c: F.col(c).cast("timestamp") for c in ("check_timestamp", "time_of_last_run")
    })
    rows = materialize(rows, "checked")
    with new_table(spark) as name:
        append_rows(rows.filter("issue_type = 'E'"), name)
        append_rows(rows.filter("issue_type = 'no such type'"), name)
        append_rows(rows.filter("issue_type <> 'E'"), name)
        stored = spark.read.schema(spark.table(name).schema).parquet(table_folder(spark, name))
    return stored.select(
        "dag_id", F.col("check_timestamp").cast("timestamp_ntz").alias("check_timestamp"), r6("overall_score"), "issue_type",
        "symbol", "symbol_code", "message", "line_number", "result_of_last_run",
        F.col("time_of_last_run").cast("timestamp_ntz").alias("time_of_last_run"),
    )
