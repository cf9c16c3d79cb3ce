import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import neighbours as K
from riskloom.operators.neighbours import checked_store


def frame(spark, x, fraud=None):
    rows = [(i, [float(v) for v in r], bool(fraud[i]) if fraud is not None else False) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, is_fraud boolean")


def vectors(n=300, d=8, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[: n // 3] = x[0] + rng.normal(size=(n // 3, d)).astype(np.float32) * 1e-3  # one crowded corner
    x[50:60] = x[0]  # exact copies
    return x


def distances(x):
    u = x.astype(np.float64)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    return 1 - u @ u.T


def brute(x, k, exclude_self):
    d = np.round(distances(x), K.TIE_DIGITS)
    out = {}
    for i in range(len(x)):
        order = sorted((d[i, j], j) for j in range(len(x)) if not (exclude_self and i == j))[:k]
        out[i] = [j for _, j in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.id)
    return out


@pytest.mark.parametrize("options", [{}, {"lists": 40, "probes": 1}, {"lists": 3, "block_rows": 40}, {"lists": 5, "probes": 5}])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_exact_search(spark, options, exclude_self):
    x = vectors()
    df = frame(spark, x).repartition(6)
    assert result(K.knn_search(df, df, 4, exclude_self=exclude_self, **options)) == brute(x, 4, exclude_self)


def test_far_lists_are_left_out(spark):
    """Two far clusters: a query of one never looks into the lists of the other."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(60, 8)) * 0.01 + np.eye(8)[0], rng.normal(size=(60, 8)) * 0.01 + np.eye(8)[1]])
    df = frame(spark, x.astype(np.float32))
    assert result(K.knn_search(df, df, 3, lists=12)) == brute(x.astype(np.float32), 3, False)


def test_nearest_pairs(spark):
    x = vectors(120)
    got = [(r.id_a, r.id_b) for r in K.nearest_pairs(frame(spark, x), 30, block_rows=32).collect()]
    d = np.round(distances(x), K.TIE_DIGITS)
    want = sorted((d[min(i, j), max(i, j)], i, j) for i in range(120) for j in range(120) if i != j)[:30]
    assert got == [(i, j) for _, i, j in want]


def test_fewer_rows_than_k_and_zero_vectors(spark):
    df = frame(spark, np.array([[1, 0], [0, 0], [0, 1]]))
    assert result(K.knn_search(df, df, 5, exclude_self=True)) == {0: [2], 2: [0]}
    assert K.knn_search(df.filter("id > 9"), df, 5).count() == 0
    assert K.knn_search(df, df, 1, max_distance=0.5).filter("query_id <> id").count() == 0


def test_verdicts(spark):
    x = np.array([[1, 0], [1, 0.01], [1, 0.02], [0, 1], [0.01, 1], [0.02, 1]])
    corpus = frame(spark, x, [1, 1, 1, 0, 0, 0])
    queries = frame(spark, np.array([[1, 0.0], [0, 1.0], [1.0, 1.0]]))
    got = {r.query_id: r for r in K.explain_verdict(queries, corpus, 3).collect()}
    assert got[0].verdict == "CONFIRMED_FRAUD" and got[0].confidence == 1.0 and got[0].nearest_legit_distance is None
    assert got[1].verdict == "LIKELY_LEGIT" and got[1].fraud_neighbors == 3 and got[1].similar_cases[0] == 3
    assert got[2].verdict in ("UNCERTAIN", "LIKELY_FRAUD")
    none = K.explain_verdict(queries, corpus.filter("id > 99"), 3).collect()
    assert {r.verdict for r in none} == {"NO_HISTORY"} and none[0].total_neighbors == 0


def test_store_checks_the_length(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0], 0.5, True, None)], "transaction_id string, embedding array<float>, fraud_score double, is_fraud boolean, metadata string")
    assert checked_store(rows, 2).first().metadata == "{}"
    with pytest.raises(Exception, match="expected 32 values per embedding, got 2"):
        checked_store(rows, 32).collect()


def clusters(n_clusters=40, size=50, d=16, seed=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_clusters, d))
    return (np.repeat(centres, size, axis=0) + rng.normal(size=(n_clusters * size, d)) * 0.02).astype(np.float32)


def test_lists_visited(spark):
    """On clustered rows a query opens a few lists of the tree, and those hold its true neighbours."""
    x = clusters()
    tree = K.build_tree(frame(spark, x), 5)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    bound = tree.bounds(unit, 5, tree.near, K.NEAR_NODES)
    fifth = np.sort(K._chords(unit, unit), axis=1)[:, 4]
    assert (bound >= fifth - 1e-9).all()
    whose, which = tree.open_lists(unit, bound)
    per_query = np.bincount(whose, minlength=len(x))
    assert len(tree.centres) == 89 and per_query.mean() < 89 / 8
    rows = {r.id: r["list"] for r in tree.rows.select("id", "list").collect()}
    opened = set(zip(whose.tolist(), which.tolist()))
    nearest = np.argsort(K._chords(unit, unit), axis=1, kind="stable")[:, :5]
    assert all((q, rows[c]) in opened for q in range(len(x)) for c in nearest[q].tolist())


def test_bounds_of_flagged_rows(spark):
    x = clusters(10, 30)
    flagged = np.arange(len(x)) % 30 < 2
    tree = K.build_tree(frame(spark, x, flagged), 3, "is_fraud", lists=20)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    third = np.sort(K._chords(unit, unit[flagged]), axis=1)[:, 2]
    bound = tree.bounds(unit, 3, tree.flagged_near, K.NEAR_NODES)
    assert (bound >= third - 1e-9).all() and np.isfinite(bound).all()


def test_pairs_of_far_lists_are_never_formed(spark):
    """The rows that visit slots grow like the rows on clustered data, not like their square."""
    def visits(n_clusters):
        x = clusters(n_clusters)
        seen = []
        whole, K.visits = K.visits, lambda *a: seen.append(whole(*a)) or seen[-1]
        try:
            got = [(r.id_a, r.id_b) for r in K.nearest_pairs(frame(spark, x), 20, block_rows=60).collect()]
        finally:
            K.visits = whole
        d = np.round(distances(x), K.TIE_DIGITS)
        a, b = np.triu_indices(len(x), 1)
        best = np.lexsort((b, a, d[a, b]))[:10]
        assert got == [p for i in best for p in ((a[i], b[i]), (b[i], a[i]))]
        return seen[0].count(), len(x)

    small, n = visits(10)
    large, m = visits(40)
    assert m == 4 * n and large < 8 * small and large < m * 10


def test_pairs_of_copies_and_few_rows(spark):
    x = np.array([[1, 0], [1, 0], [0, 1], [0, 0]])
    got = [(r.id_a, r.id_b, round(r.distance, 6)) for r in K.nearest_pairs(frame(spark, x), 100).collect()]
    assert got == [(0, 1, 0.0), (1, 0, 0.0), (0, 2, 1.0), (1, 2, 1.0), (2, 0, 1.0), (2, 1, 1.0)]
    assert K.nearest_pairs(frame(spark, x).filter("id = 3"), 5).count() == 0


def test_slots():
    first, count = K.slots_of(np.array([5, 3, 25, 0, 4, 9]), np.array([0, 0, 0, 1, 1, 1]), 10)
    assert count.tolist() == [1, 1, 3, 1, 1, 1]
    taken = [set(range(f, f + c)) for f, c in zip(first.tolist(), count.tolist())]
    assert taken[0] == taken[1] and not taken[2] & (taken[0] | taken[3] | taken[4] | taken[5])
    assert set().union(*taken) == set(range(max(map(max, taken)) + 1))


def test_whole_cases(spark):
    x = np.array([[1, 0], [1, 0.01], [1, 0.02], [0, 1], [0.01, 1], [0.02, 1]])
    cases = frame(spark, x, [1, 1, 1, 0, 0, 0]).selectExpr("*", "id / 10 AS fraud_score", "concat('{\"n\":', id, '}') AS metadata")
    row = K.explain_verdict(frame(spark, np.array([[0, 1.0]])), cases, 3).first()
    assert [(c.id, c.is_fraud, c.fraud_score, c.metadata) for c in row.cases] == [
        (3, False, 0.3, '{"n":3}'), (4, False, 0.4, '{"n":4}'), (5, False, 0.5, '{"n":5}')
    ]
    assert [c.distance for c in row.cases] == sorted(c.distance for c in row.cases) and row.similar_cases == [3, 4, 5]
    assert row.fraud_neighbors == 3 and row.nearest_fraud_distance > 0.9


def test_few_fraud_cases_and_string_ids(spark):
    x = vectors(200)
    fraud = np.arange(200) % 90 == 5
    corpus = frame(spark, x, fraud).withColumn("id", F.format_string("c%03d", "id"))
    got = {r.query_id: r for r in K.explain_verdict(frame(spark, x), corpus, 5, lists=15).collect()}
    d = np.round(distances(x), K.TIE_DIGITS)
    for i in range(200):
        near = sorted(range(200), key=lambda j: (d[i, j], j))[:5]
        assert got[i].similar_cases == [f"c{j:03d}" for j in near[:3]]
        assert got[i].fraud_neighbors == 3 and abs(got[i].nearest_fraud_distance - d[i, fraud].min()) < 1e-6
        assert abs(got[i].confidence - fraud[near].mean()) < 1e-9


def test_null_vectors_are_near_nothing(spark):
    rows = [(0, [1.0, 0.0], True), (1, None, True), (2, [0.0, 0.0], False), (3, [], False), (4, [1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>, is_fraud boolean")
    assert result(K.knn_search(df, df, 5)) == {0: [0, 4], 4: [4, 0]}
    got = {r.query_id: r.verdict for r in K.explain_verdict(df, df, 5).collect()}
    assert got[1] == got[2] == got[3] == "NO_HISTORY" and got[0] == "CONFIRMED_FRAUD"


def test_similar_cases(spark):
    x = np.array([[1, 0], [1, 0.01], [0, 1], [0.01, 1]])
    cases = frame(spark, x, [1, 0, 0, 1]).selectExpr("*", "id / 10 AS fraud_score", "concat('m', id) AS metadata")
    got = K.similar_cases(frame(spark, np.array([[1, 0.0]])), cases, 2).orderBy("rank").collect()
    assert [(r.rank, r.id, r.is_fraud, r.fraud_score, r.metadata) for r in got] == [(1, 0, True, 0.0, "m0"), (2, 1, False, 0.1, "m1")]
    bad = K.similar_cases(frame(spark, np.array([[1, 0.0]])), cases, 2, fraud_only=True).orderBy("rank").collect()
    assert [(r.rank, r.id) for r in bad] == [(1, 0), (2, 3)]
    near = K.similar_cases(frame(spark, np.array([[1, 0.0]])), cases, 4, max_distance=0.5)
    assert near.columns == ["query_id", "rank", "id", "distance", "is_fraud", "fraud_score", "metadata"] and near.count() == 2


def test_small_slots_grow_with_the_table(spark):
    """Rows without structure meet all slots: how often they are copied must not grow with the rows."""
    x = np.random.default_rng(3).normal(size=(1500, 8)).astype(np.float32)
    df = frame(spark, x, np.arange(1500) % 3 == 0)
    tree = K.build_tree(df, 3, "is_fraud", lists=2, block_rows=20)
    seen = K.visits(tree, df, lambda x: np.full(len(x), 2.0))
    assert seen.count() <= 1500 * 3 * K.SLOTS
    assert K.search(tree, df, 2, True, exclude_self=True).count() <= 1500 * 3 * K.SLOTS * 4
    got = result(K.knn_search(df, df, 2, exclude_self=True, lists=2, block_rows=20))
    assert got == brute(x, 2, True)


def test_closest_pairs_of_small_slots(spark):
    x = np.random.default_rng(5).normal(size=(1500, 8)).astype(np.float32)
    x[700:720] = x[7]
    x[1400] = x[3] + np.float32(1e-4)
    seen, whole = [], K.visits
    K.visits = lambda *a: seen.append(whole(*a)) or seen[-1]
    try:
        got = [(r.id_a, r.id_b) for r in K.nearest_pairs(frame(spark, x), 30, block_rows=10, lists=2).collect()]
    finally:
        K.visits = whole
    a, b = np.triu_indices(len(x), 1)
    d = np.round(distances(x), K.TIE_DIGITS)[a, b]
    best = np.lexsort((b, a, d))[:30]
    assert got == sorted(p for i in best for p in ((a[i], b[i]), (b[i], a[i])))[:30] and d[best].max() == 0
    assert seen[0].count() <= 1500 * 3 * K.SLOTS


def test_neighbours_closer_than_single_precision_tells(spark):
    """Distances of about 1e-8 and many copies, in tables of several tiles."""
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(1, 24)) + rng.normal(size=(1300, 24)) * 1e-4).astype(np.float32)
    x[600:1000] = x[5]
    df = frame(spark, x, np.arange(1300) % 7 == 0)
    assert result(K.knn_search(df, df, 4, exclude_self=True)) == brute(x, 4, True)
    d = np.round(distances(x), K.TIE_DIGITS)
    for r in K.explain_verdict(df, df, 4).filter("query_id % 50 = 0").collect():
        near = sorted(range(1300), key=lambda j: (d[r.query_id, j], j))[:4]
        assert r.similar_cases == near[:3] and r.fraud_neighbors == 4 and r.confidence == np.mean([j % 7 == 0 for j in near])


def test_slots_of_vectors_that_open_all_lists():
    """4,000 vectors that open 2,000 lists each do not hold all pairs of vectors and lists at once."""
    import tracemalloc

    rng = np.random.default_rng(8)
    centres = rng.normal(size=(2000, 4))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    nodes, n = centres[:45], np.full(2000, 50)
    node_of = K._chords(centres, nodes).argmin(axis=1)
    first, count = K.slots_of(n, node_of, 1000)
    near = np.zeros((2000, 3))
    tree = K.PivotTree(None, centres, node_of, nodes, np.full(2000, 2.0), near, near, first, count, 1000)
    x = np.tile(centres, (2, 1))
    tracemalloc.start()
    slots = tree.open_slots(x, np.full(4000, 1.0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(slots) == 4000 and all(len(s) == len(np.unique(first)) for s in slots)
    assert peak < 250e6


def test_a_task_holds_queries_of_half_a_slot(spark):
    """Many queries on few rows: a task holds no more of them than half of what a slot may have in rows."""
    x = np.random.default_rng(9).normal(size=(6000, 4)).astype(np.float32)
    df = frame(spark, x)
    tree = K.build_tree(df.filter("id < 1200"), 2, lists=4, block_rows=20)
    seen = K.visits(tree, df, lambda x: np.full(len(x), 2.0))
    held = K.meet(tree, seen, lambda a, b: a[["slot"]].head(1).assign(n=len(a), m=len(b)), "slot int, n long, m long").collect()
    assert sum(r.n for r in held) == seen.count() and all(r.m <= tree.block_rows for r in held)
    assert np.mean([r.n for r in held]) <= tree.block_rows / 2


def test_bounds_from_the_first_pivots(spark):
    """On rows without structure the pivots themselves, rows of the table, bound the k-th distance best."""
    x = np.random.default_rng(10).normal(size=(900, 16)).astype(np.float32)
    flagged = np.arange(900) % 3 == 0
    tree = K.build_tree(frame(spark, x, flagged), 4, "is_fraud")
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    bound = tree.bounds(unit, 4, tree.near, 1)
    assert (bound <= np.sort(K._chords(unit, tree.centres), axis=1)[:, 3] + 1e-6).all()
    for rows, near in ((unit, tree.near), (unit[flagged], tree.flagged_near)):
        assert (tree.bounds(unit, 4, near, 1) >= np.sort(K._chords(unit, rows), axis=1)[:, 3] - 1e-6).all()


def test_true_cells():
    rng = np.random.default_rng(11)
    for shape, share in (((1, 3), 0.5), ((7, 9), 0.1), ((64, 512), 0.001), ((5, 0), 0.5), ((33, 31), 0.0), ((4, 16), 1.0)):
        table = rng.random(shape) < share
        rows, cols = np.nonzero(table)
        got = K._true_cells(table) if table.size else (rows, cols)
        assert got[0].tolist() == rows.tolist() and got[1].tolist() == cols.tolist()


def test_rows_beyond_the_cut_are_not_computed(monkeypatch):
    """A second kind of rows is met with the cut that the first has left, so that few of its cells are computed."""
    unit = np.random.default_rng(12).normal(size=(4000, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    tree = K.PivotTree(None, unit[:1], np.zeros(1, dtype=int), unit[:1], np.full(1, 2.0), None, None, None, None, 4000)
    cells, exact, best = [], K._exact, K._best
    monkeypatch.setattr(K, "_exact", lambda q, c, rows, cols: cells.append(len(rows)) or exact(q, c, rows, cols))
    monkeypatch.setattr(K, "_best", lambda dist, ids, k: cells.append(dist.size) or best(dist, ids, k))
    cut, ids, lists = np.full(50, 2.0), np.arange(4000), np.zeros(2000, dtype=int)
    K._nearest(tree, unit[:50], ids[:50], cut, unit[:2000], ids[:2000], lists, 3, False)
    d = np.sort(1 - unit[:50] @ unit[:2000].T, axis=1)[:, 2]
    assert np.abs(cut - d).max() < 1e-8
    cells.clear()
    whose, which, far = K._nearest(tree, unit[:50], ids[:50], cut, unit[2000:], ids[2000:], lists, 3, False)
    assert (far <= d[whose] + 1e-8).all() and sum(cells) < 50 * 12
