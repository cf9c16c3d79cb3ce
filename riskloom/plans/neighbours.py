"""Vector store, nearest neighbours and case-based verdicts."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from riskloom.functions.vector import cosine_distance as distance
from riskloom.operators import neighbours as K
from riskloom.operators.joins import upsert_by_key
from riskloom.plans import views as V
from riskloom.plans.scalar import r6
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.sources.tables import table


def cases(spark, sf):
    return V.emb(spark, sf).select(F.col("vec_id").alias("id"), "embedding", "is_fraud", "fraud_score")


DIST = "list_cosine_distance(a.embedding::double[], b.embedding::double[])"


def ranked_sql(where="true", source_a="emb", source_b="emb"):
    return f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), id) AS rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, {DIST} AS distance, b.is_fraud FROM {source_a} a, {source_b} b WHERE {where})"""


@query("cosine_distance", with_views("emb", """
SELECT a.vec_id, round(list_cosine_distance(a.embedding::double[], b.c), 6) AS distance
FROM emb a, (SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(v) AS m FROM (
  SELECT unnest(embedding::double[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i)) b"""))
def cosine_distance(spark, sf):
    """Distance of every vector to the mean vector."""
    rows = cases(spark, sf)
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))))
    centre = rows.agg(mean.alias("m")).scalar()
    return rows.select(F.col("id").alias("vec_id"), "embedding", centre.alias("c")).select(
        "vec_id", r6("distance", distance(F.col("embedding"), F.col("c")))
    )


@query("knn_search", with_views("emb", f"""
SELECT query_id, id, rank::int AS rank, round(distance, 6) AS distance FROM ({ranked_sql('a.vec_id <> b.vec_id')}) WHERE rank <= 5"""))
def knn_search(spark, sf):
    rows = cases(spark, sf)
    return K.knn_search(rows, rows, 5, exclude_self=True).select("query_id", "id", "rank", r6("distance"))


@query("knn_search_fraud_only", with_views("emb", f"""
SELECT query_id, id, rank::int AS rank, round(distance, 6) AS distance FROM ({ranked_sql('b.is_fraud')}) WHERE rank <= 3 AND distance <= 0.9"""))
def knn_search_fraud_only(spark, sf):
    rows = cases(spark, sf)
    near = K.knn_search(rows, rows.filter("is_fraud"), 3, max_distance=0.9)
    return near.select("query_id", "id", "rank", r6("distance"))


@query("knn_search_blocked", with_views("emb", f"""
SELECT query_id, id, rank::int AS rank, round(distance, 6) AS distance FROM ({ranked_sql('a.vec_id <> b.vec_id')}) WHERE rank <= 2"""))
def knn_search_blocked(spark, sf):
    """Lists cut into several blocks."""
    rows = cases(spark, sf)
    near = K.knn_search(rows, rows, 2, exclude_self=True, lists=2, block_rows=100)
    return near.select("query_id", "id", "rank", r6("distance"))


@query("knn_topk", with_views("emb", f"""
SELECT query_id, list(id ORDER BY rank) AS nearest FROM ({ranked_sql()}) WHERE rank <= 4 GROUP BY query_id"""))
def knn_topk(spark, sf):
    rows = cases(spark, sf)
    near = K.knn_search(rows, rows, 4)
    lists = F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"])
    return near.groupBy("query_id").agg(lists.alias("nearest"))


@query("knn_search_lists", with_views("emb", f"""
SELECT query_id, id, rank::int AS rank, round(distance, 6) AS distance FROM ({ranked_sql()}) WHERE rank <= 5"""))
def knn_search_lists(spark, sf):
    """Many lists, of which a query looks into one first."""
    rows = cases(spark, sf)
    return K.knn_search(rows, rows, 5, lists=40, probes=1).select("query_id", "id", "rank", r6("distance"))


@query("knn_search_all_lists", with_views("emb", f"""
SELECT query_id, id, rank::int AS rank, round(distance, 6) AS distance FROM ({ranked_sql('a.vec_id <> b.vec_id')}) WHERE rank <= 2"""))
def knn_search_all_lists(spark, sf):
    """All lists in the first pass."""
    rows = cases(spark, sf)
    near = K.knn_search(rows, rows, 2, exclude_self=True, lists=4, probes=4, block_rows=100)
    return near.select("query_id", "id", "rank", r6("distance"))


@query("nearest_pairs_self", with_views("emb", f"""
SELECT a.vec_id AS id_a, b.vec_id AS id_b, round({DIST}, 6) AS distance FROM emb a, emb b WHERE a.vec_id <> b.vec_id
ORDER BY round({DIST}, 9), id_a, id_b LIMIT 25"""))
def nearest_pairs_self(spark, sf):
    return K.nearest_pairs(cases(spark, sf), 25, block_rows=200).select("id_a", "id_b", r6("distance"))


@query("explain_verdict", with_views("emb", f""", al AS ({ranked_sql()}), fr AS ({ranked_sql('b.is_fraud')}),
n AS (SELECT query_id, avg(is_fraud::int) AS c, count(*) AS total_neighbors, min(distance) FILTER (NOT is_fraud) AS nl,
  list(id ORDER BY rank) FILTER (rank <= 3) AS similar_cases FROM al WHERE rank <= 5 GROUP BY query_id),
f AS (SELECT query_id, count(*) AS fraud_neighbors, min(distance) AS nf FROM fr WHERE rank <= 5 GROUP BY query_id)
SELECT query_id, CASE WHEN c >= 0.8 THEN 'CONFIRMED_FRAUD' WHEN c >= 0.5 THEN 'LIKELY_FRAUD' WHEN c >= 0.3 THEN 'UNCERTAIN'
  ELSE 'LIKELY_LEGIT' END AS verdict, c AS confidence, fraud_neighbors, total_neighbors, abs(round(nf, 6)) AS nearest_fraud_distance,
  abs(round(nl, 6)) AS nearest_legit_distance, similar_cases FROM n JOIN f USING (query_id)"""))
def explain_verdict(spark, sf):
    rows = cases(spark, sf)
    out = K.explain_verdict(rows.select("id", "embedding"), rows, 5)
    return out.select(
        "query_id", "verdict", "confidence", "fraud_neighbors", "total_neighbors",
        F.abs(F.round("nearest_fraud_distance", 6)).alias("nearest_fraud_distance"),
        F.abs(F.round("nearest_legit_distance", 6)).alias("nearest_legit_distance"), "similar_cases",
    )


CASE_SQL = """round(r.distance, 6) AS distance, e.transaction_id, round(e.fraud_score, 6) AS fraud_score, e.is_fraud,
  '{"label":"'||e.vec_id%10||'"}' AS metadata"""


def whole_cases(spark, sf):
    meta = F.to_json(F.struct((F.col("vec_id") % 10).cast("string").alias("label")))
    return V.emb(spark, sf).select(
        F.col("vec_id").alias("id"), "embedding", "transaction_id", "fraud_score", "is_fraud", meta.alias("metadata")
    )


@query("similar_cases", with_views("emb", f""", r AS ({ranked_sql('b.is_fraud')})
SELECT query_id, rank::int AS rank, r.id, {CASE_SQL} FROM r JOIN emb e ON e.vec_id = r.id WHERE rank <= 4"""))
def similar_cases(spark, sf):
    """The nearest stored fraud cases with all that is stored of them."""
    rows = whole_cases(spark, sf)
    return K.similar_cases(rows.select("id", "embedding"), rows, 4, fraud_only=True).withColumns({
        c: r6(c) for c in ("distance", "fraud_score")
    })


@query("explain_verdict_cases", with_views("emb", f""", r AS ({ranked_sql()})
SELECT query_id, rank::int AS rank, r.id, {CASE_SQL} FROM r JOIN emb e ON e.vec_id = r.id WHERE rank <= 3"""))
def explain_verdict_cases(spark, sf):
    """The cases that an explanation shows, whole."""
    rows = whole_cases(spark, sf)
    shown = K.explain_verdict(rows.select("id", "embedding"), rows, 5).select("query_id", F.inline("cases"))
    return shown.withColumns({c: r6(c) for c in ("distance", "fraud_score")})


@query("embedding_drift", with_views("emb", f""", al AS ({ranked_sql('NOT a.is_fraud AND b.is_fraud')})
SELECT count(*) AS n, round(avg(distance), 6) AS mean_distance, round(max(distance), 6) AS max_distance,
  round(avg((distance > 0.6)::int), 6) AS share_above FROM al WHERE rank = 1"""))
def embedding_drift(spark, sf):
    rows = cases(spark, sf)
    out = K.embedding_drift(rows.filter("NOT is_fraud"), rows.filter("is_fraud"), 0.6)
    return out.select("n", r6("mean_distance"), r6("max_distance"), r6("share_above"))


META = """'{"label":"'||vec_id%10||'"}'"""


def stored_and_new(spark, sf):
    """Vectors already stored (three of four) and an update for two of four."""
    k = F.col("vec_id") % 4
    meta = F.to_json(F.struct((F.col("vec_id") % 10).cast("string").alias("label")))
    rows = V.emb(spark, sf).select("transaction_id", "embedding", "fraud_score", "is_fraud", meta.alias("metadata"), "vec_id")
    old = K.checked_store(rows.filter(k != 0), 64).withColumn("created_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    new = rows.filter(k < 2).withColumns({
        "fraud_score": F.lit(1.0) - F.col("fraud_score"), "metadata": F.lit(None).cast("string")})
    return old, new


@query("embedding_store", with_views("emb", f"""
SELECT transaction_id, len(embedding)::int AS dim, round(CASE WHEN vec_id%4 < 2 THEN 1 - fraud_score ELSE fraud_score END, 6) AS fraud_score,
  is_fraud, CASE WHEN vec_id%4 < 2 THEN '{{}}' ELSE {META} END AS metadata,
  CASE WHEN vec_id%4 = 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS created_at FROM emb"""))
def embedding_store(spark, sf):
    old, new = stored_and_new(spark, sf)
    return K.put_vectors(old, new, "2024-02-01", 64).select(
        "transaction_id", F.size("embedding").alias("dim"), r6("fraud_score"), "is_fraud", "metadata", "created_at"
    )


@query("upsert_by_key", """
SELECT o_custkey, o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY (o_orderstatus = 'P') DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def upsert_by_key_query(spark, sf):
    """Latest order per customer; pending orders arrive as the new batch."""
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", F.struct("o_orderdate", "o_orderkey").alias("version")
    )
    pending = F.col("o_orderstatus") == "P"
    out = upsert_by_key(rows.filter(~pending), rows.filter(pending), "o_custkey", "version")
    return out.select("o_custkey", "o_orderkey", "o_orderstatus", r6("o_totalprice"))
