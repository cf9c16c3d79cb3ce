"""Input frames of the queries, each next to the SQL that derives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.operators.behaviour import deviation_from_mean, trailing_count
from riskloom.sources.tables import table

DAY = 86_400

FEATURES = ["semantic_risk", "velocity_1h", "proxy_score", "amount_deviation"]


def with_views(names: str, body: str) -> str:
    """``body`` with the named views in front as common table expressions."""
    ctes, seen = [], set()

    def add(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for needed in NEEDS.get(name, ()):
            add(needed)
        ctes.append(f"{name} AS ({VIEW_SQL[name]})")

    for n in names.split():
        add(n)
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- transactions ---------------------------------------------------------------------------------


def txn_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"), "user_id", "ts", "event_type", "value",
        S.md5_percent(F.concat("event_type", "props")).alias("semantic_risk"),
        F.when(k % 20 < 14, 0.0).when(k % 20 < 17, 0.5).otherwise(1.0).alias("proxy_score"),
    )


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = deviation_from_mean(txn_base(spark, sf_dir), "user_id", "value")
    df = trailing_count(df, "user_id", "ts", DAY)
    sem, vel, proxy, amt = (F.col(c) for c in FEATURES)
    df = df.withColumn("velocity_1h", vel.cast("double"))
    df = df.withColumn("is_fraud", F.when(S.risk_value(sem, vel, proxy, amt) > 0.55, 1).otherwise(0))
    fraud = F.col("is_fraud") == 1
    return df.withColumn(
        "epoch", F.when(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"), "drift").otherwise("stable")
    ).withColumn(
        "pattern",
        F.when(fraud & (proxy == 1) & (amt > 1), "combined")
        .when(fraud & (proxy == 1), "proxy_ring")
        .when(fraud & (vel >= 5), "velocity_spike")
        .when(fraud, "semantic_cluster")
        .otherwise("legitimate"),
    )


def scaled_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model inputs x1..x4 and the label y."""
    return txn(spark, sf_dir).select(
        "txn_id", "epoch", "pattern",
        F.col("semantic_risk").alias("x1"), (F.col("velocity_1h") / F.lit(50.0)).alias("x2"),
        F.col("proxy_score").alias("x3"), F.col("amount_deviation").alias("x4"),
        F.col("is_fraud").cast("double").alias("y"), "is_fraud",
    )


def scored_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).withColumn(
        "score", S.rule_score(F.col("semantic_risk"), F.col("velocity_1h"), F.col("proxy_score"))
    )


# --- infrastructure health --------------------------------------------------------------------------


def infra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infra_rows(table(spark, sf_dir, "lineitem"))


def infra_rows(lines: DataFrame) -> DataFrame:
    latency = F.lit(100.0) + F.col("l_extendedprice") / F.lit(56.0)
    auth = F.when(
        ~((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0)),
        F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "R", 0.5).otherwise(0.0),
    )
    df = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_suppkey").cast("string").alias("customer_id"),
        latency.alias("amazon_api_latency"), auth.alias("cs_auth_status"),
        (F.lit(2.0) * F.col("l_quantity")).alias("system_cpu_load"),
    )
    return df.withColumn(
        "architecture_efficiency",
        S.efficiency_value(F.col("amazon_api_latency"), F.col("cs_auth_status"), F.col("system_cpu_load")),
    )


# --- raw card rows (all text) -------------------------------------------------------------------------


def _pick(key: Column, *values: str | None) -> Column:
    out = F.when(key == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(key == i, F.lit(v))
    return out


def raw_ieee(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    price = F.floor("o_totalprice")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), c == F.col("c_custkey"))
    return joined.select(
        "o_orderkey",
        F.concat(
            F.expr("floor(o_totalprice) div 500").cast("string"), F.lit("."),
            F.lpad((price % 100).cast("string"), 2, "0"),
        ).alias("TransactionAmt"),
        (day.cast("bigint") * DAY % 20_000_000).cast("string").alias("TransactionDT"),
        _pick(o % 4, "visa", "mastercard", "american express", "").alias("card4"),
        _pick(c % 3, "debit", "credit", "").alias("card6"),
        _pick(o % 5, "mobile", "Mobile", "desktop", "", None).alias("DeviceType"),
        _pick(o % 6, "", "nan", "Windows", "0.35", "1.7", None).alias("DeviceInfo"),
        _pick(c % 7, "gmail.com", " Yahoo.com ", "hotmail.com", "", "proton.me", "anonymous.com", None).alias(
            "P_emaildomain"
        ),
        _pick(o % 9, "gmail.com", "", None, "corp.example", "a.org", "b.org", "c.org", "YAHOO.com", "d.org").alias(
            "R_emaildomain"
        ),
        F.when(c % 11 == 0, "").when(c % 11 == 1, "n/a").when(c % 11 == 2, "0")
        .otherwise((F.col("c_nationkey") + 100).cast("string")).alias("addr1"),
        F.when(o % 37 == 0, "1").when(o % 41 == 0, "").when(o % 43 == 0, "junk").otherwise("0").alias("isFraud"),
    )


# --- partitioned log ------------------------------------------------------------------------------------


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (e % 3).cast("int").alias("partition"), F.floor(e / 3).alias("offset"),
        F.when(e % 17 == 0, "{bad").when(e % 101 == 0, '{"a":1} x').when(e % 103 == 0, '{"a":1,"a":2}')
        .otherwise(F.col("props")).alias("value"),
    )


def synced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows a table already holds: the first 80 % of the offsets."""
    rows = log(spark, sf_dir)
    top = rows.agg((F.max("offset") * F.lit(0.8)).alias("m")).scalar()
    return rows.filter(F.col("offset") < top)


# --- envelopes of two source systems ----------------------------------------------------------------------


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_rows(table(spark, sf_dir, "orders"))


def envelope_rows(orders: DataFrame) -> DataFrame:
    """Two events per order: one system reports the order, the other one the payment."""
    order_id = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")

    def envelope(tag: str, system: str, payload: list[Column]) -> Column:
        meta = F.struct(
            F.concat(F.lit(f"{tag}-"), F.col("o_orderkey").cast("string")).alias("event_id"),
            F.lit(system).alias("source_system"), at.alias("ingestion_ts"), F.lit("2.1").alias("schema_version"),
        )
        return F.to_json(F.struct(meta.alias("metadata"), F.struct(order_id.alias("order_id"), *payload).alias("payload")))

    shop = envelope("S", "SHOP", [
        F.col("o_orderstatus").alias("order_status"),
        F.concat(F.lit("item-"), (F.col("o_custkey") % 500).cast("string")).alias("sku"),
        (F.col("o_orderkey") % 3 + 1).cast("int").alias("quantity"),
    ])
    pay = envelope("P", "PAYMENT", [
        _pick(F.col("o_orderkey") % 3, "paid", "refused", "held").alias("decision"),
        F.floor("o_totalprice").alias("amount"), (F.col("o_custkey") % 101).cast("int").alias("fraud_score"),
    ])
    return orders.select(order_id.alias("key"), F.explode(F.array(shop, pay)).alias("value"))


# --- pipeline runs, task spans, lint issues -----------------------------------------------------------------


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a pipeline; every 13th has no end time yet, every 29th left no error lines."""
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("dag_"), F.col("o_custkey").cast("string")).alias("dag_id"), o.alias("run_id"),
        F.col("o_orderdate").alias("execution_date"),
        F.when(o % 13 != 0, F.expr("o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey % 90 AS INT))"))
        .alias("end_date"),
        _state().alias("state"), (o % 29 != 0).alias("has_error_lines"),
    )


def _state() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "F", "failed").when(status == "O", "success").otherwise("running")


def task_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", (F.col("user_id") % 5).cast("string")).alias("dag_id"), F.col("ts").alias("start_date"),
        F.when(
            F.col("event_id") % 50 != 0,
            F.expr("ts + make_dt_interval(0, 0, CAST(floor(value) AS INT) % 240 - 3)"),
        ).alias("end_date"),
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("dag_"), F.col("l_suppkey").cast("string")).alias("dag_id"),
        F.col("l_shipdate").alias("check_timestamp"),
        (F.lit(10.0) * (F.lit(1.0) - F.col("l_discount"))).alias("overall_score"),
        F.when(flag == "A", "E").when(flag == "R", "W").otherwise("C").alias("issue_type"),
        F.concat(F.lit("rule-"), (F.col("l_partkey") % 40).cast("string")).alias("symbol"),
        F.concat(F.lit("C0"), (F.col("l_partkey") % 90 + 10).cast("string")).alias("symbol_code"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("message"),
        F.col("l_linenumber").alias("line_number"), "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
    )


# --- texts ----------------------------------------------------------------------------------------------------


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text replies; seven of twelve carry a short answer instead of prose."""
    k = (F.col("conv_id") + F.col("turn")) % 12
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.coalesce(
            _pick(k, "0.7", "Score: 0,3", "1.5 then 0.2", "none", "", "0.5f", "risk\tis\n0.25 of 1"), F.col("text")
        ).alias("reply"),
    )


def bad_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.coalesce(
            _pick(F.col("p_partkey") % 12, "", " 1.5 ", "abc", "nan", "inf", "0.5f", "1e3", "-inf"),
            F.when(F.col("p_partkey") % 12 == 8, F.concat(F.lit("-"), size))
            .when(F.col("p_partkey") % 12 == 9, F.concat(F.lit("."), size))
            .when(F.col("p_partkey") % 12 == 10, F.concat(size, F.lit("."))),
        ).alias("raw"),
    )


def task_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task log per document: its whole text between job lines, some with a stack trace or a log link."""
    d = F.col("doc_id")
    head = F.concat(F.lit("24/01/05 10:00:00 INFO Client: job "), d.cast("string"), F.lit("\n"))
    link = F.when(
        d % 3 == 0,
        F.concat(
            F.lit("LogFile: s3://batch-logs-"), (d + 100_000).cast("string"),
            F.lit("-us-east-1/emr_logs/j-"), d.cast("string"), F.lit("AB/steps/s-"), d.cast("string"),
            F.lit("Z/stderr.gz\n"),
        ),
    ).otherwise("")
    trace = F.when(
        d % 4 == 0,
        "24/01/05 10:00:01 ERROR Client: Application diagnostics message: User class threw exception: boom\n"
        "  at step one\n  at step two\n24/01/05 10:00:02 INFO Client: end\n",
    ).otherwise("")
    last = F.when(
        d % 8 == 0,
        "24/01/05 10:00:03 ERROR Client: Application diagnostics message: User class threw exception: again\n"
        "  at the end",
    ).otherwise("24/01/05 10:00:04 INFO Client: bye")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(head, F.col("text"), F.lit("\n"), link, trace, last).alias("log")
    )


def lint_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output of a linter per part: an array of messages in noise, sometimes cut short."""
    p = F.col("p_partkey")
    key = p.cast("string")
    one = F.concat(
        F.lit('{"type": "'), _pick(p % 4, "error", "warning", "convention", "fatal"),
        F.lit('", "symbol": "rule-'), (p % 40).cast("string"), F.lit('", "message-id": "C'), key,
        F.lit('", "message": "'), F.col("p_type"), F.lit('", "line": '), F.col("p_size").cast("string"), F.lit("}"),
    )
    bare = F.concat(F.lit('{"message": "only '), key, F.lit('"}'))
    body = _pick(p % 5, "[]", "", None, None, None)
    body = (
        F.when(p % 5 == 2, F.concat(F.lit("["), one, F.lit("]")))
        .when(p % 5 == 3, F.concat(F.lit("["), one, F.lit(", "), bare, F.lit("]")))
        .when(p % 5 == 4, F.concat(F.lit("["), one, F.lit("{]")))
        .otherwise(body)
    )
    rating = F.when(
        p % 6 != 0, F.concat(F.lit("rated at "), F.round(F.col("p_size") / F.lit(5.0), 2).cast("string"), F.lit("/10"))
    ).otherwise("no score")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("checking\n"), body, F.lit("\ndone")).alias("output"),
        F.concat(F.lit("Your code has been "), rating, F.lit(" (previous run: 9.1/10)")).alias("score_output"),
    )


# --- vectors ------------------------------------------------------------------------------------------------------


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("transaction_id"), "embedding",
        (F.col("label") / F.lit(9.0)).alias("fraud_score"), F.col("label").isin(0, 1, 2).alias("is_fraud"), "vec_id",
    )


# --- the same in SQL -------------------------------------------------------------------------------------------------

NEEDS: dict[str, tuple[str, ...]] = {
    "txn": ("txn_f",), "txn_f": ("txn_b",), "scaled": ("txn",), "scored": ("txn",), "main_table": ("log",),
}

VIEW_SQL: dict[str, str] = {
    "txn_b": """
SELECT event_id AS txn_id, user_id, ts, event_type, value,
  (('0x'||substr(md5(event_type||props),1,8))::BIGINT % 100)/100.0::double AS semantic_risk,
  CAST(json_extract_string(props,'$.k') AS int) AS k,
  (count(*) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW))::double AS velocity_1h,
  avg(value) OVER (PARTITION BY user_id) AS mu, stddev_pop(value) OVER (PARTITION BY user_id) AS sd
FROM events""",
    "txn_f": """
SELECT txn_id, user_id, ts, event_type, value, semantic_risk, velocity_1h,
  CAST(CASE WHEN k%20<14 THEN 0.0 WHEN k%20<17 THEN 0.5 ELSE 1.0 END AS double) AS proxy_score,
  round(CASE WHEN sd > 0 THEN least(3.0, abs(value-mu)/sd) ELSE 0.0 END, 6)::double AS amount_deviation FROM txn_b""",
    "txn": """
SELECT *, CASE WHEN is_fraud=1 AND proxy_score=1 AND amount_deviation>1 THEN 'combined'
    WHEN is_fraud=1 AND proxy_score=1 THEN 'proxy_ring' WHEN is_fraud=1 AND velocity_1h>=5 THEN 'velocity_spike'
    WHEN is_fraud=1 THEN 'semantic_cluster' ELSE 'legitimate' END AS pattern
FROM (SELECT *,
  CASE WHEN 0.4*semantic_risk+0.05*velocity_1h/50+0.3*proxy_score+0.15*semantic_risk*amount_deviation>0.55
       THEN 1 ELSE 0 END AS is_fraud,
  CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN 'drift' ELSE 'stable' END AS epoch FROM txn_f)""",
    "scaled": """
SELECT txn_id, epoch, pattern, semantic_risk AS x1, velocity_1h/50 AS x2, proxy_score AS x3, amount_deviation AS x4,
  is_fraud::double AS y, is_fraud FROM txn""",
    "scored": """
SELECT *, 0.5*semantic_risk + 0.3*proxy_score + 0.2*least(1.0, velocity_1h/20) AS score FROM txn""",
    "infra": """
SELECT *, CASE WHEN cs_auth_status IS NOT NULL THEN greatest(0.0, least(1.0,
    0.6*(1-amazon_api_latency/2000) + 0.3*cs_auth_status - 0.4*(amazon_api_latency/2000)*(system_cpu_load/100)
    - 0.1*(system_cpu_load/100)*(system_cpu_load/100)))::double END AS architecture_efficiency
FROM (SELECT l_orderkey::varchar AS order_id, l_suppkey::varchar AS customer_id,
  100 + l_extendedprice/56 AS amazon_api_latency,
  (CASE WHEN l_linenumber=7 AND l_tax=0 THEN NULL WHEN l_returnflag='A' THEN 1.0 WHEN l_returnflag='R' THEN 0.5
   ELSE 0.0 END)::double AS cs_auth_status, 2*l_quantity AS system_cpu_load FROM lineitem)""",
    "raw_ieee": """
SELECT o_orderkey,
  (floor(o_totalprice)::bigint // 500)::varchar || '.' || lpad((floor(o_totalprice)::bigint % 100)::varchar, 2, '0')
    AS "TransactionAmt",
  (date_diff('day', DATE '1992-01-01', o_orderdate::date)::bigint * 86400 % 20000000)::varchar AS "TransactionDT",
  CASE o_orderkey%4 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'american express' ELSE '' END AS card4,
  CASE o_custkey%3 WHEN 0 THEN 'debit' WHEN 1 THEN 'credit' ELSE '' END AS card6,
  CASE o_orderkey%5 WHEN 0 THEN 'mobile' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'desktop' WHEN 3 THEN '' END AS "DeviceType",
  CASE o_orderkey%6 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN 'Windows' WHEN 3 THEN '0.35' WHEN 4 THEN '1.7' END
    AS "DeviceInfo",
  CASE o_custkey%7 WHEN 0 THEN 'gmail.com' WHEN 1 THEN ' Yahoo.com ' WHEN 2 THEN 'hotmail.com' WHEN 3 THEN ''
    WHEN 4 THEN 'proton.me' WHEN 5 THEN 'anonymous.com' END AS "P_emaildomain",
  CASE o_orderkey%9 WHEN 0 THEN 'gmail.com' WHEN 1 THEN '' WHEN 3 THEN 'corp.example' WHEN 4 THEN 'a.org'
    WHEN 5 THEN 'b.org' WHEN 6 THEN 'c.org' WHEN 7 THEN 'YAHOO.com' WHEN 8 THEN 'd.org' END AS "R_emaildomain",
  CASE o_custkey%11 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN '0' ELSE (c_nationkey+100)::varchar END AS addr1,
  CASE WHEN o_orderkey%37=0 THEN '1' WHEN o_orderkey%41=0 THEN '' WHEN o_orderkey%43=0 THEN 'junk' ELSE '0' END
    AS "isFraud"
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "log": """
SELECT (event_id%3)::int AS "partition", event_id//3 AS "offset",
  CASE WHEN event_id%17=0 THEN '{bad' WHEN event_id%101=0 THEN '{"a":1} x' WHEN event_id%103=0 THEN '{"a":1,"a":2}'
    ELSE props END AS value FROM events""",
    "main_table": """
SELECT * FROM log WHERE "offset" < (SELECT max("offset")*0.8::double FROM log)""",
    "runs": """
SELECT 'dag_'||o_custkey AS dag_id, o_orderkey AS run_id, o_orderdate AS execution_date,
  CASE WHEN o_orderkey%13<>0 THEN o_orderdate + to_minutes(o_orderkey%90) END AS end_date,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'running' END AS state,
  o_orderkey%29<>0 AS has_error_lines FROM orders""",
    "task_spans": """
SELECT event_type||(user_id%5)::varchar AS dag_id, ts AS start_date,
  CASE WHEN event_id%50<>0 THEN ts + to_minutes(floor(value)::int % 240 - 3) END AS end_date FROM events""",
    "issues": """
SELECT 'dag_'||l_suppkey AS dag_id, l_shipdate AS check_timestamp, 10.0::double*(1-l_discount) AS overall_score,
  CASE l_returnflag WHEN 'A' THEN 'E' WHEN 'R' THEN 'W' ELSE 'C' END AS issue_type,
  'rule-'||(l_partkey%40) AS symbol, 'C0'||(l_partkey%90+10) AS symbol_code, 'order '||l_orderkey AS message,
  l_linenumber AS line_number, l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem""",
    "replies": """
SELECT conv_id, turn, CASE (conv_id+turn)%12 WHEN 0 THEN '0.7' WHEN 1 THEN 'Score: 0,3' WHEN 2 THEN '1.5 then 0.2'
  WHEN 3 THEN 'none' WHEN 4 THEN '' WHEN 5 THEN '0.5f' WHEN 6 THEN 'risk'||chr(9)||'is'||chr(10)||'0.25 of 1'
  ELSE text END AS reply FROM conversations""",
    "bad_numbers": """
SELECT p_partkey, CASE p_partkey%12 WHEN 0 THEN '' WHEN 1 THEN ' 1.5 ' WHEN 2 THEN 'abc' WHEN 3 THEN 'nan'
  WHEN 4 THEN 'inf' WHEN 5 THEN '0.5f' WHEN 6 THEN '1e3' WHEN 7 THEN '-inf' WHEN 8 THEN '-'||p_size
  WHEN 9 THEN '.'||p_size WHEN 10 THEN p_size||'.' END AS raw FROM part""",
    "task_logs": """
SELECT doc_id, '24/01/05 10:00:00 INFO Client: job '||doc_id||chr(10)||text||chr(10)
  ||CASE WHEN doc_id%3=0 THEN 'LogFile: s3://batch-logs-'||(doc_id+100000)||'-us-east-1/emr_logs/j-'||doc_id
      ||'AB/steps/s-'||doc_id||'Z/stderr.gz'||chr(10) ELSE '' END
  ||CASE WHEN doc_id%4=0 THEN '24/01/05 10:00:01 ERROR Client: Application diagnostics message: User class threw '
      ||'exception: boom'||chr(10)||'  at step one'||chr(10)||'  at step two'||chr(10)
      ||'24/01/05 10:00:02 INFO Client: end'||chr(10) ELSE '' END
  ||CASE WHEN doc_id%8=0 THEN '24/01/05 10:00:03 ERROR Client: Application diagnostics message: User class threw '
      ||'exception: again'||chr(10)||'  at the end' ELSE '24/01/05 10:00:04 INFO Client: bye' END AS log
FROM documents""",
    "lint_outputs": """
SELECT p_partkey, 'checking'||chr(10)||CASE p_partkey%5 WHEN 0 THEN '[]' WHEN 1 THEN '' WHEN 2 THEN '['||one||']'
    WHEN 3 THEN '['||one||', {"message": "only '||p_partkey||'"}]' ELSE '['||one||'{]' END||chr(10)||'done' AS output,
  'Your code has been '||CASE WHEN p_partkey%6<>0 THEN 'rated at '||round(p_size/5.0::double,2)||'/10'
    ELSE 'no score' END||' (previous run: 9.1/10)' AS score_output
FROM (SELECT *, '{"type": "'||CASE p_partkey%4 WHEN 0 THEN 'error' WHEN 1 THEN 'warning' WHEN 2 THEN 'convention'
    ELSE 'fatal' END||'", "symbol": "rule-'||(p_partkey%40)||'", "message-id": "C'||p_partkey||'", "message": "'
    ||p_type||'", "line": '||p_size||'}' AS one FROM part)""",
    "emb": """
SELECT vec_id::varchar AS transaction_id, embedding, label/9.0::double AS fraud_score, label IN (0,1,2) AS is_fraud,
  vec_id FROM embeddings""",
}
