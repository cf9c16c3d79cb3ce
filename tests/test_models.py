import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.models import documents as D
from riskloom.models import logistic as L
from riskloom.models import network as N
from riskloom.models import pairs as P
from riskloom.models import wide as W
from riskloom.operators import metrics as M
from riskloom.plans import models as plans
from riskloom.plans import views as V

# Eight sample rows of the feature schema.
SAMPLE = [
    (0.80, 12.0, 1.0, 2.1, 1), (0.20, 3.0, 0.0, 0.3, 0), (0.60, 25.0, 0.5, 1.5, 1), (0.10, 2.0, 0.0, 0.2, 0),
    (0.90, 18.0, 1.0, 2.8, 1), (0.30, 5.0, 0.2, 0.4, 0), (0.70, 20.0, 0.8, 1.8, 1), (0.15, 4.0, 0.1, 0.3, 0),
]


def basis(x, i, j, form):
    return np.column_stack([x[:, i] ** p * x[:, j] ** q for p, q in P.FORMS[form]])


def data(n=800, width=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, width))
    y = (x[:, 0] * x[:, 1] + 0.3 * x[:, 2] + 0.1 * rng.normal(size=n) > 0.5).astype(float)
    split = np.where(np.arange(n) < 0.7 * n, "train", "val")
    return x, y, split


def narrow_frame(spark, x, y, split):
    return spark.createDataFrame([(*map(float, r), float(t), str(s)) for r, t, s in zip(x, y, split)], "x1 double, x2 double, x3 double, x4 double, y double, split string")


def wide_frame(spark, x, y, split):
    return spark.createDataFrame([([float(v) for v in r], float(t), str(s)) for r, t, s in zip(x, y, split)], "x array<double>, y double, split string")


def test_pair_fit_equals_least_squares(spark):
    x, y, split = data()
    forms = tuple(P.FORMS)
    fits = P.pair_fit(P.pair_moments(narrow_frame(spark, x, y, split), ["x1", "x2", "x3", "x4"], "y", "split", forms), "split", forms)
    tr, va = split == "train", split == "val"
    rows = fits.collect()
    assert len(rows) == 36
    for r in rows:
        i, j = int(r.a[1]) - 1, int(r.b[1]) - 1
        a = basis(x, i, j, r.form)
        c = np.linalg.lstsq(a[tr], y[tr], rcond=None)[0]
        assert np.allclose(r.coeffs, c, atol=1e-6)
        assert r.val_mse == pytest.approx(np.mean((a[va] @ c - y[va]) ** 2), abs=1e-9)


def test_collinear_inputs_give_the_shortest_solution(spark):
    x, y, split = data()
    x[:, 3] = 0.0
    fits = P.pair_fit(P.pair_moments(narrow_frame(spark, x, y, split), ["x1", "x4"], "y", "split"), "split").first()
    a = basis(x, 0, 3, 2)
    c = np.linalg.lstsq(a[split == "train"], y[split == "train"], rcond=None)[0]
    assert np.allclose(fits.coeffs, c, atol=1e-8)


def numpy_two_layers(x, y, split):
    tr, va = split == "train", split == "val"
    nodes = []
    for i, j in itertools.combinations(range(x.shape[1]), 2):
        a = basis(x, i, j, 2)
        c = np.linalg.lstsq(a[tr], y[tr], rcond=None)[0]
        nodes.append((np.mean((a[va] @ c - y[va]) ** 2), i, j, c))
    best = sorted(nodes, key=lambda t: t[0])[:2]
    z = np.column_stack([basis(x, i, j, 2) @ c for _, i, j, c in best])
    a = basis(z, 0, 1, 2)
    c = np.linalg.lstsq(a[tr], y[tr], rcond=None)[0]
    return a @ c, np.sqrt(np.mean((a[va] @ c - y[va]) ** 2))


def test_pair_model(spark):
    x, y, split = data()
    df = narrow_frame(spark, x, y, split)
    model = P.train_pair_model(df, ["x1", "x2", "x3", "x4"], "y", "split")
    pred, rmse = numpy_two_layers(x, y, split)
    assert model.rmse == pytest.approx(rmse, abs=1e-8) and model.training_rows == 560
    got = [r[0] for r in df.select(model.score()).collect()]
    assert np.allclose(got, np.clip(pred, 0, 1), atol=1e-7)
    again = D.PairModel.from_document(json.dumps(model.to_document()))
    assert again.nodes == model.nodes and again.master.coeffs == model.master.coeffs
    back = D.PairModel.from_table(model.to_table(spark, "m"), "m")
    assert back.nodes == model.nodes and back.master.coeffs == model.master.coeffs


def test_published_model_on_sample_rows(spark):
    df = spark.createDataFrame(SAMPLE, "semantic_risk double, velocity_1h double, proxy_score double, amount_deviation double, is_fraud int")
    from riskloom.models.engines import pair_engine

    got = [r.score for r in pair_engine(df).collect()]
    doc = D.FRAUD_MODEL
    for (sem, vel, proxy, amt, _), score in zip(SAMPLE, got):
        x = {"x1": sem, "x2": vel / 50, "x3": proxy, "x4": amt}
        z = []
        for n in doc["layer1"]:
            a, b = x[n["inputs"][0]], x[n["inputs"][1]]
            z.append(n["intercept"] + n["coeffs"][0] * a + n["coeffs"][1] * b + n["coeffs"][2] * a * b)
        raw = doc["beta0"] + doc["betas"][0] * z[0] + doc["betas"][1] * z[1] + doc["betas"][2] * z[0] * z[1]
        assert score == pytest.approx(min(1.0, max(0.0, raw)))


def test_quality_of_the_trained_model(spark, sf):
    """Least quality on transactions, on the drifted part, and per fraud pattern."""
    sf = sf.replace("sf0.001", "sf0.01")
    model = P.train_pair_model(plans.split_txn(spark, sf), ["x1", "x2", "x3", "x4"], "y", "split")
    scored = V.scaled_txn(spark, sf).withColumn("score", model.score())
    m = M.evaluate(scored, threshold=0.5, one_class=0.5).first()
    assert m.auc_roc >= 0.78 and m.precision >= 0.5 and m.recall >= 0.4 and m.f1 >= 0.45 and model.rmse < 0.35
    per = {r.epoch: r for r in M.evaluate(scored, threshold=0.5, one_class=0.5, by=["epoch"]).collect()}
    assert per["drift"].auc_roc >= 0.62 and per["stable"].recall - per["drift"].recall < 0.4
    checks = D.size_and_bounds(model.to_table(spark, "m")).first()
    assert checks.nodes_ok and checks.coef_ok
    assert len(json.dumps(model.to_document()).encode()) < 2048


@pytest.mark.parametrize("clip", [False, True])
def test_wide_model_equals_numpy(spark, clip):
    x, y, split = data(600, 7, 1)
    df = wide_frame(spark, x, y, split).repartition(5)
    model = W.train_wide(df, "x", "y", "split", 7, max_pairs=12, forms=(2, 4), keep=None if clip else 6, clip_nodes=clip)
    tr, va = split == "train", split == "val"
    pairs = W.sampled_pairs(spark, 7, 12, 42)
    assert len(pairs) == 12
    fits = []
    for (i, j), form in itertools.product(pairs, (2, 4)):
        a = basis(x, i, j, form)
        c = np.linalg.lstsq(a[tr], y[tr], rcond=None)[0]
        fits.append((np.mean((a[va] @ c - y[va]) ** 2), i, j, form, c))
    chosen = sorted(fits, key=lambda t: (t[1:4] if clip else t[:4]))[: 24 if clip else 6]
    assert [(n.a, n.b, n.form) for n in model.nodes] == [t[1:4] for t in chosen]
    z = np.column_stack([basis(x, i, j, f) @ c for _, i, j, f, c in chosen])
    z = np.clip(z, 0, 1) if clip else z
    a = np.column_stack([np.ones(len(x)), z])
    c = np.linalg.lstsq(a[tr], y[tr], rcond=None)[0]
    pred = a @ c
    assert model.errors["train_mse"] == pytest.approx(np.mean((pred[tr] - y[tr]) ** 2), abs=1e-6)
    assert model.errors["val_mse_clipped"] == pytest.approx(np.mean((np.clip(pred[va], 0, 1) - y[va]) ** 2), abs=1e-4)
    again = W.WideModel.from_document(model.to_document())
    got = [r.score for r in W.score_wide(df, "x", again).collect()]
    assert len(got) == 600 and min(got) >= 0 and max(got) <= 1


def test_pair_sample_is_bounded_and_seeded(spark):
    a = W.sampled_pairs(spark, 10, 20, 1)
    assert len(a) == 20 and all(i < j < 10 for i, j in a) and a == W.sampled_pairs(spark, 10, 20, 1) != W.sampled_pairs(spark, 10, 20, 2)
    assert len(W.sampled_pairs(spark, 4, 100, 1)) == 6


def test_logistic_equals_numpy(spark):
    x, y, _ = data(500)
    df = narrow_frame(spark, x, y, ["train"] * 500)
    model = L.train_logistic(df, ["x1", "x2", "x3", "x4"], "y", steps=5, rate=0.1)
    q = (x - x.mean(0)) / (x.std(0) + 1e-8)
    w, b, k = np.zeros(4), 0.0, (1 - y.mean()) / y.mean()
    for _ in range(5):
        e = (1 / (1 + np.exp(-(q @ w + b))) - y) * np.where(y == 1, k, 1.0)
        w, b = w - 0.1 * q.T @ e / len(y), b - 0.1 * e.mean()
    assert np.allclose(model.weights, w) and model.bias == pytest.approx(b)
    p = [r.score for r in model.apply(df).collect()]
    assert np.allclose(p, 1 / (1 + np.exp(-(q @ w + b))))


def test_network_forward(spark):
    x, y, split = data(50, 6)
    rng = np.random.default_rng(4)
    sizes = [6, 5, 4, 1]
    net = N.DenseNetwork([rng.normal(size=s) for s in zip(sizes, sizes[1:])], [rng.normal(size=n) for n in sizes[1:]], x_mean=x.mean(0), x_std=x.std(0))
    a = (x - x.mean(0)) / (x.std(0) + 1e-8)
    for w, b in list(zip(net.weights, net.biases))[:-1]:
        a = np.maximum(a @ w + b, 0)
    want = 1 / (1 + np.exp(-(a @ net.weights[-1] + net.biases[-1]).ravel()))
    df = wide_frame(spark, x, y, split)
    assert np.allclose([r.score for r in N.nn_forward(df, "x", net).collect()], want)
    assert np.allclose([r.embedding for r in N.nn_embedding(df, "x", net).collect()], a, atol=1e-5)


def test_trained_network_beats_chance(spark):
    x, y, split = data(800, 6, 9)
    df = wide_frame(spark, x, y, split)
    model = N.train_mlp(df.filter("split = 'train'"), "x", "y", (8,), 6)
    scored = N.score_mlp(df.filter("split = 'val'"), "x", model)
    assert M.auc(scored, label="y").first()[0] > 0.8


def test_pseudo_embedding_is_stable(spark):
    df = spark.range(5).select("id", N.pseudo_embedding(F.col("id"), F.lit(0.5), F.lit(10.0), F.lit(1.0), F.lit(1.5)).alias("e"))
    a, b = ([r.e for r in d.orderBy("id").collect()] for d in (df, df.repartition(3)))
    assert a == b and len(a[0]) == 32 and a[0] != a[1]
    assert a[0][:4] == pytest.approx([0.5, 0.2, 1.0, 0.5])


def test_network_document_round_trip(spark):
    rng = np.random.default_rng(2)
    doc = {
        "weights": [rng.normal(size=(4, 3)).tolist(), rng.normal(size=(3, 1)).tolist()], "biases": [[[0.1, 0.2, 0.3]], [[0.4]]],
        "bn_gamma": [[[1.0, 2.0, 0.5]]], "bn_beta": [[[0.0, 0.1, 0.2]]], "bn_running_mean": [[[0.1, 0.0, 0.2]]],
        "bn_running_var": [[[1.0, 0.5, 2.0]]], "normalization": {"X_mean": [0.0, 1.0, 2.0, 3.0], "X_std": [1.0, 2.0, 1.0, 0.5]},
    }
    net = N.DenseNetwork.from_document(json.dumps(doc))
    x = rng.normal(size=(6, 4))
    z = (x - np.array([0, 1, 2, 3.0])) / (np.array([1, 2, 1, 0.5]) + N.EPS) @ np.array(doc["weights"][0]) + np.array([0.1, 0.2, 0.3])
    z = np.array([1, 2, 0.5]) * (z - np.array([0.1, 0, 0.2])) / np.sqrt(np.array([1, 0.5, 2]) + N.EPS) + np.array([0, 0.1, 0.2])
    y = 1 / (1 + np.exp(-(np.maximum(z, 0) @ np.array(doc["weights"][1]) + 0.4)))
    assert np.allclose(net.forward(x), y.ravel())
    assert np.allclose(N.DenseNetwork.from_document(net.to_document()).forward(x), y.ravel())


def test_network_scores_against_a_plain_forward_pass(spark, sf):
    """The fitted weights of the stored vectors' network, applied to every row in NumPy."""
    from riskloom.models import network as N
    from riskloom.plans.models import scaled_wide

    rows, n = scaled_wide(spark, sf)
    model = N.train_mlp(rows.filter("split = 'train'"), "x", "y", N.HIDDEN_LAYERS, n, max_iter=5)
    scored = N.score_mlp(rows, "x", model).collect()
    weights, layers = model.weights.toArray(), [n, *N.HIDDEN_LAYERS, 2]
    out, at = np.array([r.x for r in scored]), 0
    for k, (size, width) in enumerate(zip(layers, layers[1:])):
        w = weights[at : at + size * width].reshape(size, width)  # Spark keeps the columns of a width x size matrix
        out = out @ w + weights[at + size * width : at + (size + 1) * width]
        at += (size + 1) * width
        if k + 2 < len(layers):
            out = 1 / (1 + np.exp(-out))
    assert at == len(weights)
    e = np.exp(out - out.max(axis=1, keepdims=True))
    assert len(scored) > 400
    np.testing.assert_allclose([r.score for r in scored], e[:, 1] / e.sum(axis=1), atol=1e-9)


@pytest.mark.parametrize("size", [1, 3, 8, 40])
def test_elimination_in_sql(size):
    import duckdb

    from riskloom.plans.models import eliminated

    rng = np.random.default_rng(size)
    x = rng.normal(size=(3 * size, size))
    gram, moment = x.T @ x, rng.normal(size=size)
    m = np.column_stack([gram, moment]).tolist()
    con = duckdb.connect()
    con.execute("CREATE TABLE s AS SELECT 1 AS sys, ?::DOUBLE[][] AS m UNION ALL SELECT 2, ?::DOUBLE[][]", [m, (2 * np.array(m)).tolist()])
    rows = con.execute(f"WITH RECURSIVE {eliminated('e', 's', 'sys')} SELECT sys, c FROM e_solved ORDER BY sys").fetchall()
    assert [r[0] for r in rows] == [1, 2]
    for _, c in rows:
        np.testing.assert_allclose(c, np.linalg.solve(gram, moment), rtol=1e-6, atol=1e-9)
