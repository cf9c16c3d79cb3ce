"""Training of pair models, wide models and networks."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from riskloom.models import documents as D
from riskloom.models import logistic as L
from riskloom.models import network as N
from riskloom.models import pairs as P
from riskloom.models import wide as W
from riskloom.operators import metrics as M
from riskloom.operators.selection import hash_split, head_rows, head_split, sample_rows
from riskloom.plans import views as V
from riskloom.plans.scalar import r6
from riskloom.plans.views import with_views
from riskloom.registry import query
from riskloom.session import materialize, scratch_dir
from riskloom.sources import files
from riskloom.sources.tables import table

X4 = ["x1", "x2", "x3", "x4"]
X3 = ["x1", "x2", "x3"]


def split_once(spark, sf):
    """Model inputs of all transactions, for a single pass."""
    keys = table(spark, sf, "events").select(F.col("event_id").alias("txn_id"))
    return head_split(V.scaled_txn(spark, sf), "txn_id", keys=keys).select(*X4, "y", "split")


def split_txn(spark, sf):
    """The same as a stage table that the passes of a trainer read."""
    return materialize(split_once(spark, sf), "training-rows")


def split_infra(spark, sf):
    rows = V.infra(spark, sf).filter("cs_auth_status IS NOT NULL").select(
        "order_id", (F.col("amazon_api_latency") / F.lit(2000.0)).alias("x1"), F.col("cs_auth_status").alias("x2"),
        (F.col("system_cpu_load") / F.lit(100.0)).alias("x3"), F.col("architecture_efficiency").alias("y"),
    )
    return hash_split(rows, "order_id")


HEAD = """t AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY txn_id) <= floor(count(*) OVER () * 0.7::double) THEN 'train'
  ELSE 'val' END AS split FROM scaled)"""
HASHED = """t AS (SELECT order_id, amazon_api_latency/2000 AS x1, cs_auth_status AS x2, system_cpu_load/100 AS x3,
  architecture_efficiency AS y, CASE WHEN ('0x'||substr(md5('42:'||order_id),1,8))::BIGINT % 10 < 7 THEN 'train' ELSE 'val' END AS split
  FROM infra WHERE cs_auth_status IS NOT NULL)"""


# --- the same fits in SQL: Cramer's rule on the 4 x 4 normal equations ---------------------------------------


def det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    parts = []
    for j, head in enumerate(m[0]):
        minor = [row[:j] + row[j + 1:] for row in m[1:]]
        parts.append(f"{'-' if j % 2 else '+'}{head}*({det(minor)})")
    return "".join(parts)


def moments_sql(source: str, pairs: list[tuple[str, str]], forms=(2,)) -> str:
    plain, basis = P.moment_powers(forms)

    def mono(p, q):
        return "*".join(["1.0::double", *["xa"] * p, *["xb"] * q])

    sums = ", ".join(
        [f"sum({mono(p, q)}) AS s{p}{q}" for p, q in plain] + [f"sum({mono(p, q)}*y) AS y{p}{q}" for p, q in basis]
    )
    rows = " UNION ALL ".join(f"SELECT split, '{a}' AS a, '{b}' AS b, {a} AS xa, {b} AS xb, y FROM {source}" for a, b in pairs)
    return f"SELECT split, a, b, {sums}, sum(y*y) AS yy FROM ({rows}) GROUP BY split, a, b"


def fit_sql(moments: str) -> str:
    """(a, b, c0..c3, train_mse, val_mse) of form 2."""
    powers = P.FORMS[2]
    g = [[f"t.s{a1 + a2}{b1 + b2}" for a2, b2 in powers] for a1, b1 in powers]
    y = [f"t.y{a}{b}" for a, b in powers]
    whole = det(g)
    cs = []
    for k in range(4):
        replaced = [row[:k] + [y[i]] + row[k + 1:] for i, row in enumerate(g)]
        cs.append(f"({det(replaced)})/({whole}) AS c{k}")
    sides = f"SELECT t.a, t.b, {', '.join(cs)}, t AS tr, v AS va FROM ({moments}) t JOIN ({moments}) v ON t.a=v.a AND t.b=v.b AND t.split='train' AND v.split='val'"

    def mse(side):
        quad = "+".join(
            f"c{i}*c{j}*{side}.s{powers[i][0] + powers[j][0]}{powers[i][1] + powers[j][1]}" for i in range(4) for j in range(4)
        )
        cross = "+".join(f"c{i}*{side}.y{a}{b}" for i, (a, b) in enumerate(powers))
        return f"({side}.yy - 2*({cross}) + {quad})/{side}.s00"

    return f"SELECT a, b, c0, c1, c2, c3, {mse('tr')} AS train_mse, {mse('va')} AS val_mse FROM ({sides})"


def model_fit_sql(features: list[str]) -> str:
    pairs = list(combinations(features, 2))
    pick = {s: "CASE n." + s + " " + " ".join(f"WHEN '{f}' THEN t.{f}" for f in features) + " END" for s in "ab"}
    z = f"n.c0 + n.c1*{pick['a']} + n.c2*{pick['b']} + n.c3*({pick['a']})*({pick['b']})"
    return f"""mo AS ({moments_sql('t', pairs)}), fits AS ({fit_sql('SELECT * FROM mo')}),
best AS (SELECT *, row_number() OVER (ORDER BY val_mse, a, b) AS rn FROM fits QUALIFY rn <= 2),
zz AS (SELECT t.split, t.y, z1, z2 FROM (SELECT t.*, {z} AS z1 FROM t, best n WHERE n.rn = 1) t,
  LATERAL (SELECT {z} AS z2 FROM best n WHERE n.rn = 2)),
mz AS ({moments_sql('zz', [('z1', 'z2')])}), top AS ({fit_sql('SELECT * FROM mz')})"""


def coef_rows_sql(extra: str = "") -> str:
    parts = []
    for k, term in enumerate(("intercept", "a", "b", "ab")):
        parts.append(f"SELECT 1 AS layer, 'node_'||a||'_'||b AS node, '{term}' AS term, round(c{k}, 4) AS coef FROM best")
        parts.append(f"SELECT 2, 'master', '{term}', round(c{k}, 4) FROM top")
    parts.append("SELECT 2, 'master', 'rmse', round(sqrt(val_mse), 4) FROM top")
    parts.append("SELECT 2, 'master', 'training_rows', (SELECT count(*) FROM t WHERE split='train')::double FROM top")
    return " UNION ALL ".join(parts) + extra


def coef_rows(spark, model):
    coefs = model.to_table(spark, "m").select("layer", "node", "term", F.round("coef", 4).alias("coef"))
    extra = spark.createDataFrame(
        [(2, "master", "rmse", round(model.rmse, 4)), (2, "master", "training_rows", float(model.training_rows))],
        coefs.schema,
    )
    return coefs.unionByName(extra)


MOMENT_COLS = P.moment_names((2,))
PAIRS4 = list(combinations(X4, 2))


@query("pair_moments", with_views("scaled", f""", {HEAD}
SELECT split, a, b, {', '.join(f'round({c}, 8) AS {c}' for c in MOMENT_COLS)} FROM ({moments_sql('t', PAIRS4)})"""))
def pair_moments(spark, sf):
    df = P.pair_moments(split_once(spark, sf), X4, "y", "split")
    return df.select("split", "a", "b", *[F.round(c, 8).alias(c) for c in MOMENT_COLS])


@query("pair_fit", with_views("scaled", f""", {HEAD}, mo AS ({moments_sql('t', PAIRS4)})
SELECT a, b, {', '.join(f'round(c{k}, 5) AS c{k}' for k in range(4))}, round(train_mse, 6) AS train_mse,
  round(sqrt(val_mse), 6) AS rmse FROM ({fit_sql('SELECT * FROM mo')})"""))
def pair_fit(spark, sf):
    fits = P.pair_fit(P.pair_moments(split_once(spark, sf), X4, "y", "split"), "split")
    return fits.select("a", "b", *[F.round(F.get("coeffs", k), 5).alias(f"c{k}") for k in range(4)], r6("train_mse"), r6("rmse"))


@query("topk_nodes", with_views("scaled", f""", {HEAD}, mo AS ({moments_sql('t', PAIRS4)})
SELECT a, b, round(sqrt(val_mse), 6) AS rmse FROM ({fit_sql('SELECT * FROM mo')}) ORDER BY val_mse, a, b LIMIT 2"""))
def topk_nodes(spark, sf):
    fits = P.pair_fit(P.pair_moments(split_once(spark, sf), X4, "y", "split"), "split")
    return P.topk_nodes(fits, 2).select("a", "b", r6("rmse"))


@query("pair_model_train_v1", with_views("scaled", f", {HEAD}, {model_fit_sql(X4)} {coef_rows_sql()}"))
def pair_model_train_v1(spark, sf):
    return coef_rows(spark, P.train_pair_model(split_txn(spark, sf), X4, "y", "split"))


@query("health_model_train", with_views("infra", f", {HASHED}, {model_fit_sql(X3)} {coef_rows_sql()}"))
def health_model_train(spark, sf):
    return coef_rows(spark, P.train_pair_model(split_infra(spark, sf), X3, "y", "split"))


@query("health_model_score", with_views("infra", f""", {HASHED}, {model_fit_sql(X3)},
p AS (SELECT c0 + c1*z1 + c2*z2 + c3*z1*z2 AS pred FROM zz, top WHERE split = 'val')
SELECT round(avg(pred), 4) AS health_score, (SELECT round(sqrt(val_mse), 4) FROM top) AS rmse,
  CASE WHEN avg(pred) > 0.75 THEN 'OK' WHEN avg(pred) > 0.45 THEN 'WARN' ELSE 'CRITICAL' END AS status FROM p"""))
def health_model_score(spark, sf):
    from riskloom.functions.scalar import health_status

    rows = split_infra(spark, sf)
    model = P.train_pair_model(rows, X3, "y", "split")
    mean = F.avg(model.raw_score())
    return rows.filter("split = 'val'").agg(
        F.round(mean, 4).alias("health_score"), F.lit(round(model.rmse, 4)).alias("rmse"),
        health_status(mean).alias("status"),
    )


MAX_COEF = "greatest(" + ", ".join(f"max(abs(c{k}))" for k in range(4)) + ")"
PUBLISHED_MAX = max(abs(c) for n in D.FRAUD_MODEL["layer1"] for c in [n["intercept"], *n["coeffs"]])


@query("model_size_check", with_views("scaled", f""", {HEAD}, {model_fit_sql(X4)},
m AS (SELECT greatest((SELECT {MAX_COEF} FROM best), (SELECT {MAX_COEF} FROM top)) AS c)
SELECT 'trained' AS model_id, 2::bigint AS n_nodes, round(c, 4) AS max_coef, true AS nodes_ok, c < 50 AS coef_ok, true AS size_ok FROM m
UNION ALL SELECT 'published', 2, round({PUBLISHED_MAX!r}e0, 4), true, {str(PUBLISHED_MAX < 50).lower()}, true"""))
def model_size_check(spark, sf):
    """Structure of the model trained on the transactions, and of the published one."""
    trained = P.train_pair_model(split_txn(spark, sf), X4, "y", "split")
    published = D.PairModel.from_document(D.FRAUD_MODEL)
    coefs = trained.to_table(spark, "trained").unionByName(published.to_table(spark, "published"))
    return D.size_and_bounds(coefs).select(
        "model_id", "n_nodes", F.round("max_coef", 4).alias("max_coef"), "nodes_ok", "coef_ok", "size_ok"
    )


@query("sink_json_model", with_views("scaled", f", {HEAD}, {model_fit_sql(X4)} " + " UNION ALL ".join(
    f"SELECT 1 AS layer, (rn - 1)::int AS position, 'node_'||a||'_'||b AS node, '{t}' AS term, round(c{k}, 4) AS coef FROM best "
    f"UNION ALL SELECT 2, 0, 'master', '{t}', round(c{k}, 4) FROM top" for k, t in enumerate(D.TERMS))))
def sink_json_model(spark, sf):
    """A model trained on all transactions, written as a document and read back as a coefficient table."""
    path = scratch_dir(spark, "trained-model")
    files.write_document(spark, P.train_pair_model(split_txn(spark, sf), X4, "y", "split").to_document(), path)
    model = D.PairModel.from_document(files.read_document(spark, path))
    return model.to_table(spark, "trained").select("layer", "position", "node", "term", F.round("coef", 4).alias("coef"))


BASIS = ", ".join(
    f"SELECT txn_id, {form} AS form, [{', '.join('*'.join(['1.0::double', *['x1'] * p, *['x4'] * q]) for p, q in powers)}] "
    "AS basis FROM scaled UNION ALL" for form, powers in P.FORMS.items()
).replace("UNION ALL, ", "UNION ALL ").removesuffix(" UNION ALL")


@query("poly_basis", with_views("scaled", BASIS))
def poly_basis(spark, sf):
    rows = V.scaled_txn(spark, sf)
    cells = F.array(*[
        F.struct(F.lit(f).alias("form"), P.poly_basis(F.col("x1"), F.col("x4"), f).alias("basis"))
        for f in P.FORMS
    ])
    return rows.select("txn_id", F.explode(cells).alias("c")).select("txn_id", "c.*")


@query("train_val_split_head", with_views("scaled", f", {HEAD} SELECT txn_id, split FROM t"))
def train_val_split_head(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").alias("txn_id"))
    return head_split(rows, "txn_id").select("txn_id", "split")


@query("train_val_split_random", """SELECT event_id, CASE WHEN ('0x'||substr(md5('42:'||event_id),1,8))::BIGINT % 10 < 7 THEN 'train'
  ELSE 'val' END AS split FROM events""")
def train_val_split_random(spark, sf):
    return hash_split(table(spark, sf, "events"), "event_id").select("event_id", "split")


@query("src_head_n", "SELECT event_id, event_type, round(value, 6) AS value FROM events ORDER BY event_id LIMIT 50000")
def src_head_n(spark, sf):
    return head_rows(table(spark, sf, "events"), "event_id", 50_000).select("event_id", "event_type", r6("value"))


@query("src_sample_n", """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
ORDER BY md5('42:'||o_orderkey), o_orderkey LIMIT 5000""")
def src_sample_n(spark, sf):
    return sample_rows(table(spark, sf, "orders"), "o_orderkey", 5000).select("o_orderkey", r6("o_totalprice"))


# --- wide models: the stored vectors as features, labels 0, 1 and 2 as the positive class -----------------------


def wide_rows(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"),
        F.col("label").isin(0, 1, 2).cast("double").alias("y"),
    )
    return hash_split(rows, "vec_id")


def wide_width(spark, sf):
    """Features per row, from the first row (all rows are checked when they are stacked)."""
    return table(spark, sf, "embeddings").select(F.size("embedding")).first()[0]


def scaled_wide(spark, sf):
    n = wide_width(spark, sf)
    return W.minmax_array(wide_rows(spark, sf), "x", n), n


def wide_sql(pairs: int, scaled: bool, split: bool) -> str:
    """Fits of the sampled pairs: (a, b, c0..c3, train_mse, val_mse) as ``fits``; the pair rows as ``tp``."""
    cell = "(x - lo)/(hi - lo + 1e-8)" if scaled else "x"
    part = "CASE WHEN ('0x'||substr(md5('42:'||vec_id),1,8))::BIGINT % 10 < 7 THEN 'train' ELSE 'val' END" if split else "'train'"
    plain, basis = P.moment_powers((2,))

    def mono(p, q):
        return "*".join(["1.0::double", *["xa"] * p, *["xb"] * q])

    sums = ", ".join([f"sum({mono(p, q)}) AS s{p}{q}" for p, q in plain] + [f"sum({mono(p, q)}*y) AS y{p}{q}" for p, q in basis])
    twice = "" if split else " UNION ALL SELECT 'val' AS split, * EXCLUDE (split) FROM mo0"
    return f"""WITH u AS (SELECT vec_id, (label IN (0,1,2))::int::double AS y, unnest(embedding::double[]) AS x,
  generate_subscripts(embedding, 1) AS i FROM embeddings),
mm AS (SELECT i, min(x) AS lo, max(x) AS hi FROM u GROUP BY i),
sv AS (SELECT vec_id, y, {part} AS split, list({cell} ORDER BY i) AS v FROM u JOIN mm USING (i) GROUP BY vec_id, y),
pr AS (SELECT a::int AS a, b::int AS b FROM range(64) r(a), range(64) t(b) WHERE a < b ORDER BY md5('42:'||a||':'||b) LIMIT {pairs}),
tp AS (SELECT split, a, b, v[a+1] AS xa, v[b+1] AS xb, y FROM sv, pr),
mo0 AS (SELECT split, a, b, {sums}, sum(y*y) AS yy FROM tp GROUP BY split, a, b), mo AS (SELECT split, * EXCLUDE (split) FROM mo0{twice}),
fits AS ({fit_sql('SELECT * FROM mo')})"""


def nodes_sql(order: str, keep: int, source: str = "fits") -> str:
    return f"""SELECT (row_number() OVER (ORDER BY {order}) - 1)::int AS rank, a AS feat_i, b AS feat_j, 2 AS form_type,
  round(val_mse, 6) AS val_mse, round(train_mse, 6) AS train_mse FROM {source} QUALIFY rank < {keep}"""


CLIPPED_FITS = """cf AS (SELECT f.a, f.b, avg(d*d) FILTER (split='train') AS train_mse, avg(d*d) FILTER (split='val') AS val_mse FROM (
  SELECT f.a, f.b, t.split, greatest(0.0, least(1.0, c0 + c1*xa + c2*xb + c3*xa*xb)) - y AS d FROM fits f JOIN tp t ON f.a=t.a AND f.b=t.b) f GROUP BY f.a, f.b)"""


def wide_result(spark, model):
    nodes = W.model_rows(spark, model).select("rank", "feat_i", "feat_j", "form_type", r6("val_mse"), r6("train_mse"))
    return nodes


# --- fits of any size in SQL: elimination without square roots, one step per recursion ---------------------------


def eliminated(name: str, source: str, keys: str) -> str:
    """A recursive expression that clears one column per step from all systems of ``source`` (keys, m): m has a system's
    rows with the right side as last cell. The solution is ``{name}_solved`` (keys, c)."""
    pivot = "list_transform(m[k], lambda x: x / m[k][k])"
    step = "list_transform(m, lambda r, i: CASE WHEN i = k THEN p ELSE list_transform(r, lambda x, j: x - r[k] * p[j]) END)"
    return f"""{name} AS (SELECT {keys}, 1 AS k, m, {pivot.replace("k]", "1]")} AS p FROM {source}
  UNION ALL SELECT {keys}, k, m, {pivot} FROM (SELECT {keys}, k + 1 AS k, {step} AS m FROM {name} WHERE k <= len(m))),
{name}_solved AS (SELECT {keys}, list_transform(m, lambda r: r[len(r)]) AS c FROM {name} WHERE k > len(m))"""


def form_fits_sql(pairs: int, forms) -> str:
    """Fits of the sampled pairs in every form as ``fits`` (a, b, form, c, train_mse, val_mse); scaled rows as ``sv``."""
    plain, basis = P.moment_powers(forms)

    def mono(p, q):
        return "*".join(["1.0::double", *["xa"] * p, *["xb"] * q])

    sums = [f"sum({mono(p, q)}) AS s{p}{q}" for p, q in plain] + [f"sum({mono(p, q)}*y) AS y{p}{q}" for p, q in basis]

    def system(form):
        rows = [[f"s{a1 + a2}{b1 + b2}" for a2, b2 in P.FORMS[form]] + [f"y{a1}{b1}"] for a1, b1 in P.FORMS[form]]
        cells = ", ".join(f"[{', '.join(r)}]" for r in rows)
        return f"SELECT a, b, {form} AS form, [{cells}] AS m FROM mo WHERE split = 'train'"

    def fit(form):
        powers = list(enumerate(P.FORMS[form], 1))

        def mse(t):
            quad = "+".join(f"c[{i}]*c[{j}]*{t}.s{a + d}{b + e}" for i, (a, b) in powers for j, (d, e) in powers)
            cross = "+".join(f"c[{i}]*{t}.y{a}{b}" for i, (a, b) in powers)
            return f"greatest(0.0, {t}.yy - 2*({cross}) + {quad})/{t}.s00"

        return f"""SELECT f.a, f.b, form, c, {mse('t')} AS train_mse, {mse('v')} AS val_mse FROM fit_solved f
  JOIN mo t ON t.a = f.a AND t.b = f.b AND t.split = 'train' JOIN mo v ON v.a = f.a AND v.b = f.b AND v.split = 'val' WHERE form = {form}"""

    rows = wide_sql(pairs, True, True)
    return f"""{rows[:rows.index("mo0 AS")].replace("WITH u", "WITH RECURSIVE u", 1)}
mo AS MATERIALIZED (SELECT split, a, b, {', '.join(sums)}, sum(y*y) AS yy FROM tp GROUP BY split, a, b),
systems AS ({' UNION ALL '.join(map(system, forms))}),
{eliminated('fit', 'systems', 'a, b, form')},
fits AS MATERIALIZED ({' UNION ALL '.join(map(fit, forms))})"""


def second_layer_sql(nodes: int, order: str, clip: bool) -> str:
    """Second-layer output of each row as ``out`` (vec_id, split, y, raw), on the first ``nodes`` fits of form 2."""
    z = "c[1] + c[2]*v[a+1] + c[3]*v[b+1] + c[4]*v[a+1]*v[b+1]"
    z = f"greatest(0.0, least(1.0, {z}))" if clip else z
    return f"""best AS (SELECT *, row_number() OVER (ORDER BY {order}) AS n FROM fits QUALIFY n <= {nodes}),
zr AS MATERIALIZED (SELECT vec_id, split, y, list_concat([1.0::double], list({z} ORDER BY n), [y]) AS r FROM sv, best GROUP BY vec_id, split, y),
cells AS (SELECT i, j, sum(r[i] * r[j]) AS v FROM zr, range(1, {nodes + 2}) x(i), range(1, {nodes + 3}) z(j) WHERE split = 'train' GROUP BY i, j),
layer AS (SELECT 1 AS sys, list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM cells GROUP BY i)),
{eliminated('top', 'layer', 'sys')},
out AS (SELECT vec_id, split, y, list_inner_product(c, r[1:{nodes + 1}]) AS raw FROM zr, top_solved)"""


FORM_SEARCH = f"""{form_fits_sql(300, tuple(P.FORMS))},
kept AS (SELECT *, row_number() OVER (ORDER BY val_mse, a, b, form) - 1 AS rank FROM fits QUALIFY rank < 50)"""


@query("pair_sample", """SELECT * FROM (SELECT a::int AS a, b::int AS b FROM range(64) x(a), range(64) z(b) WHERE a < b
  AND 64 = (SELECT max(len(embedding)) FROM embeddings) ORDER BY md5('42:'||a||':'||b) LIMIT 300)""")
def pair_sample(spark, sf):
    return W.pair_sample(spark, wide_width(spark, sf), 300)


@query("pair_model_train_generic", f"{wide_sql(11, False, True)}, {CLIPPED_FITS} {nodes_sql('a, b', 11, source='cf')}")
def pair_model_train_generic(spark, sf):
    rows, n = wide_rows(spark, sf), wide_width(spark, sf)
    return wide_result(spark, W.train_generic(rows, "x", "y", "split", n))


@query("pair_model_train_full", f"""{form_fits_sql(100, (2,))}, {second_layer_sql(100, 'a, b', True)},
err AS (SELECT split, power(raw - y, 2) AS e, power(greatest(0.0, least(1.0, raw)) - y, 2) AS clipped FROM out)
SELECT metric, round(value, 6) AS value FROM (SELECT split || '_mse' AS metric, avg(e) AS value FROM err GROUP BY split
  UNION ALL SELECT split || '_mse_clipped', avg(clipped) FROM err GROUP BY split UNION ALL SELECT 'full_mse_clipped', avg(clipped) FROM err)""")
def pair_model_train_full(spark, sf):
    rows, n = scaled_wide(spark, sf)
    model = W.train_full(rows, "x", "y", "split", n)
    return W.model_errors(spark, model).select("metric", r6("value"))


@query("pair_model_train_random", f"{wide_sql(50, True, False)} {nodes_sql('a, b', 50)}")
def pair_model_train_random(spark, sf):
    rows, n = scaled_wide(spark, sf)
    return wide_result(spark, W.train_random(rows, "x", "y", n))


@query("pair_model_train_selforg", f"{wide_sql(500, True, True)} {nodes_sql('val_mse, a, b', 50)}")
def pair_model_train_selforg(spark, sf):
    rows, n = scaled_wide(spark, sf)
    return wide_result(spark, W.train_selforg(rows, "x", "y", "split", n))


@query("pair_model_train_formsearch", f"""{FORM_SEARCH} SELECT rank::int AS rank, a AS feat_i, b AS feat_j, form AS form_type,
  round(val_mse, 6) AS val_mse, round(train_mse, 6) AS train_mse FROM kept""")
def pair_model_train_formsearch(spark, sf):
    rows, n = scaled_wide(spark, sf)
    return wide_result(spark, W.train_formsearch(rows, "x", "y", "split", n))


@query("form_histogram", f"""{FORM_SEARCH} SELECT form AS form_type, count(*) AS n,
  round(100.0::double * count(*) / sum(count(*)) OVER (), 6) AS percent FROM kept GROUP BY form""")
def form_histogram(spark, sf):
    rows, n = scaled_wide(spark, sf)
    model = W.train_formsearch(rows, "x", "y", "split", n)
    return W.form_histogram(W.model_rows(spark, model)).select("form_type", "n", r6("percent"))


@query("score_wide_model", f"""{form_fits_sql(500, (2,))}, {second_layer_sql(50, 'val_mse, a, b', False)}
SELECT vec_id, round(greatest(0.0, least(1.0, raw)), 6) AS score FROM out""")
def score_wide_model(spark, sf):
    rows, n = scaled_wide(spark, sf)
    model = W.train_selforg(rows, "x", "y", "split", n)
    return W.score_wide(rows, "x", model).select("vec_id", r6("score"))


# A small network in the published layout: (feature, feature, form, coefficients) and the second layer.
STORED_NODES = [(0, 1, 4, [0.1, 0.2, -0.1, 0.05, 0.03, -0.02]), (2, 3, 6, [0.2, -0.1, 0.1, 0.02, 0.01, 0.04, -0.03, 0.02]),
                (62, 63, 2, [0.3, 0.1, 0.2, -0.05])]
STORED_LAYER2 = [0.1, 0.5, 0.4, 0.3]


def stored_sql() -> str:
    """The same network written out: powers of embedding cells times coefficients."""
    def node(a, b, terms):
        return " + ".join(f"({c!r}e0 * pow(e[{a + 1}], {p}) * pow(e[{b + 1}], {q}))" for c, (p, q) in terms)

    basis = {2: [(0, 0), (1, 0), (0, 1), (1, 1)], 4: [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2)],
             6: [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2), (2, 1), (1, 2)]}
    parts = [f"{w!r}e0 * ({node(a, b, zip(c, basis[form]))})" for w, (a, b, form, c) in zip(STORED_LAYER2[1:], STORED_NODES)]
    return f"{STORED_LAYER2[0]!r}e0 + {' + '.join(parts)}"


@query("score_wide_document", f"""SELECT vec_id, round(greatest(0.0, least(1.0, y))::double, 6) AS score
FROM (SELECT vec_id, {stored_sql()} AS y FROM (SELECT vec_id, embedding::double[] AS e FROM embeddings))""")
def score_wide_document(spark, sf):
    """A network document in the published layout, written, read back and applied."""
    path = scratch_dir(spark, "wide-document")
    model = W.WideModel([W.WideNode(*n) for n in STORED_NODES], STORED_LAYER2, n_features=64)
    files.write_document(spark, model.to_published(), path)
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    scored = W.score_wide(rows, "x", W.WideModel.from_published(files.read_document(spark, path)))
    return scored.select("vec_id", r6("score"))


@query("label_last_col", """SELECT count(*) AS n_rows, 64 AS n_features, 'label' AS target,
  round(avg(CASE WHEN label IN (0,1,2) THEN 1 ELSE 0 END), 6) AS rate, round(avg(embedding[1]::double), 6) AS mean_first,
  round(avg(list_sum(embedding::double[])), 6) AS mean_sum FROM embeddings""")
def label_last_col(spark, sf):
    from riskloom.operators.schema import assemble, target_column

    rows = table(spark, sf, "embeddings").select(
        *[F.get("embedding", i).cast("double").alias(f"f{i}") for i in range(64)], F.col("label").isin(0, 1, 2).cast("int").alias("label")
    )
    target, features = target_column(rows)
    packed = assemble(rows, features, target)
    return packed.agg(
        F.count("*").alias("n_rows"), F.lit(len(features)).alias("n_features"), F.lit(target).alias("target"),
        r6("rate", F.avg("y")), r6("mean_first", F.avg(F.get("x", 0))),
        r6("mean_sum", F.avg(F.aggregate("x", F.lit(0.0), lambda s, v: s + v))),
    )


# --- logistic regression ------------------------------------------------------------------------------------------


def z_sql():
    return ", ".join(f"(x{i+1} - avg(x{i+1}) OVER ()) / (stddev_pop(x{i+1}) OVER () + 1e-8) AS q{i+1}" for i in range(4))


def logreg_steps() -> str:
    """Weights after 50 gradient steps as ``w50``; scaled rows as ``q``."""
    z = "w.b + " + " + ".join(f"w.w{i}*q{i}" for i in range(1, 5))
    err = f"(1/(1+exp(-greatest(-500, least(500, {z})))) - y) * CASE WHEN y=1 THEN k ELSE 1 END"
    steps = ", ".join(["b - 0.001*avg(e)", *[f"w{i} - 0.001*avg(e*q{i})" for i in range(1, 5)]])
    return f""", q AS MATERIALIZED (SELECT txn_id, y, (1-avg(y) OVER ())/avg(y) OVER () AS k, {z_sql()} FROM scaled),
w50 AS MATERIALIZED (SELECT * FROM (WITH RECURSIVE w(s, b, w1, w2, w3, w4) AS (SELECT 0, 0.0::double, 0.0::double, 0.0::double, 0.0::double, 0.0::double
  UNION ALL SELECT s + 1, {steps} FROM (SELECT w.*, q.q1, q.q2, q.q3, q.q4, {err} AS e FROM w, q WHERE w.s < 50) GROUP BY s, b, w1, w2, w3, w4)
SELECT * FROM w WHERE s = 50))"""


LOGREG_ROWS = """SELECT 'bias' AS term, round(b, 8) AS weight FROM w50 UNION ALL SELECT 'x1', round(w1, 8) FROM w50
UNION ALL SELECT 'x2', round(w2, 8) FROM w50 UNION ALL SELECT 'x3', round(w3, 8) FROM w50 UNION ALL SELECT 'x4', round(w4, 8) FROM w50"""


@query("logreg_train", with_views("scaled", f"{logreg_steps()} {LOGREG_ROWS}"))
def logreg_train(spark, sf):
    model = L.train_logistic(V.scaled_txn(spark, sf), X4, "y")
    rows = [("bias", float(model.bias)), *zip(model.features, map(float, model.weights))]
    return spark.createDataFrame(rows, "term string, weight double").select("term", F.round("weight", 8).alias("weight"))


def logreg_eval_sql() -> str:
    from riskloom.plans.metrics import BEST, auc_sql, sweep_sql

    score = "1/(1+exp(-greatest(-500, least(500, b + w1*q1 + w2*q2 + w3*q3 + w4*q4))))"
    return with_views("scaled", f"""{logreg_steps()},
scored AS MATERIALIZED (SELECT y::int AS is_fraud, {score} AS score FROM q, w50), a AS ({auc_sql(default='0.5')}),
best AS (SELECT * FROM ({sweep_sql(BEST)}) ORDER BY f1 DESC, threshold LIMIT 1)
SELECT threshold, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc,
  CASE WHEN f1 >= 0.45 AND precision >= 0.5 AND recall >= 0.4 AND auc_roc >= 0.78 THEN 'PASS' ELSE 'FAIL' END AS gate FROM best, a""")


@query("logreg_evaluate", logreg_eval_sql())
def logreg_evaluate(spark, sf):
    """Best threshold and gate of the logistic model on the rows it was trained on."""
    rows = V.scaled_txn(spark, sf)
    scored = L.train_logistic(rows, X4, "y").apply(rows)
    best = M.best_f1(M.threshold_sweep(scored, M.grid(*M.BEST_F1_GRID)))
    ok = (F.col("f1") >= 0.45) & (F.col("precision") >= 0.5) & (F.col("recall") >= 0.4) & (F.col("auc_roc") >= 0.78)
    both = best.withColumn("auc_roc", M.auc(scored, one_class=0.5).scalar())
    return both.select("threshold", "tp", "fp", "fn", r6("precision"), r6("recall"), r6("f1"), r6("auc_roc"),
                       F.when(ok, "PASS").otherwise("FAIL").alias("gate"))


# --- networks -------------------------------------------------------------------------------------------------------


def wave_network(n: int) -> N.DenseNetwork:
    """Stored weights given by a formula, so that the same forward pass can be written in SQL."""
    sizes = [n, 32, 1]

    def wave(rows, cols, a, b):
        i, j = np.meshgrid(np.arange(rows), np.arange(cols), indexing="ij")
        return np.sin(i * a + j * b + 1.0) * 0.5

    return N.DenseNetwork(
        weights=[wave(sizes[0], sizes[1], 3.0, 5.0), wave(sizes[1], sizes[2], 2.0, 7.0)],
        biases=[np.cos(np.arange(32.0)) * 0.1, np.array([-0.2])],
        gamma=[1.0 + np.arange(32.0) / 32], beta=[np.arange(32.0) / 64 - 0.25], mean=[np.arange(32.0) / 100],
        var=[1.0 + np.arange(32.0) / 10],
    )


HIDDEN_SQL = """list_transform(range(32), lambda j: greatest(0.0::double,
  (1.0 + j/32.0::double) * (list_sum(list_transform(range(len(embedding)), lambda i: embedding[i+1]::double * sin(i*3.0::double + j*5.0::double + 1)*0.5))
    + cos(j::double)*0.1 - j/100.0::double) / sqrt(1.0 + j/10.0::double + 1e-8) + j/64.0::double - 0.25))"""


@query("nn_forward", f"""SELECT vec_id, round(1/(1+exp(-(list_sum(list_transform(range(32), lambda j: h[j+1]*sin(j*2.0::double + 1)*0.5)) - 0.2))), 6) AS score
FROM (SELECT vec_id, {HIDDEN_SQL} AS h FROM embeddings)""")
def nn_forward(spark, sf):
    rows = table(spark, sf, "embeddings")
    return N.nn_forward(rows, "embedding", wave_network(wide_width(spark, sf))).select("vec_id", r6("score"))


@query("nn_embedding", f"""SELECT vec_id, 32 AS dim, list_transform(h, lambda v: round(v::float::double, 4)) AS hidden
FROM (SELECT vec_id, {HIDDEN_SQL} AS h FROM embeddings)""")
def nn_embedding(spark, sf):
    rows = N.nn_embedding(table(spark, sf, "embeddings"), "embedding", wave_network(wide_width(spark, sf)), "h")
    return rows.select("vec_id", F.size("h").alias("dim"), F.transform("h", lambda v: F.round(v.cast("double"), 4)).alias("hidden"))


def noise_sql(tag, i):
    return f"(('0x'||substr(md5('{tag}:{i}:'||txn_id),1,8))::BIGINT::double / 2147483648 - 1)"


PSEUDO_PARTS = (
    ["semantic_risk", "velocity_1h/50", "proxy_score", "amount_deviation/3"]
    + [f"({b})*(1.0::double + {0.1 * math.sqrt(3)!r}::double*{noise_sql('jitter', i)})"
       for i, b in enumerate(["semantic_risk", "velocity_1h/50", "proxy_score", "amount_deviation/3"])]
    + [f"(semantic_risk + velocity_1h/50 + proxy_score + amount_deviation/3)/4 + {0.2 * math.sqrt(3)!r}::double*{noise_sql('rest', i)}" for i in range(24)]
)


@query("pseudo_embedding", with_views("txn", f"""SELECT txn_id, list_transform([{', '.join(PSEUDO_PARTS)}], lambda v: round(v::float::double, 4) + 0.0::double) AS embedding FROM txn"""))
def pseudo_embedding(spark, sf):
    cols = [F.col(c) for c in V.FEATURES]
    rows = V.txn(spark, sf).select("txn_id", N.pseudo_embedding(F.col("txn_id"), *cols).alias("e"))
    return rows.select("txn_id", F.transform("e", lambda v: F.round(v.cast("double"), 4) + 0.0).alias("embedding"))


@query("mlp_train")
def mlp_train(spark, sf):
    """Network on the training rows, judged on the validation rows."""
    rows, n = scaled_wide(spark, sf)
    model = N.train_mlp(rows.filter("split = 'train'"), "x", "y", N.HIDDEN_LAYERS, n)
    scored = N.score_mlp(rows.filter("split = 'val'"), "x", model)
    return M.evaluate(scored, label="y", one_class=0.5).select(
        "tp", "fp", "fn", "tn", r6("precision"), r6("recall"), r6("f1"), r6("auc_roc")
    )
