import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import concurrency as C
from riskloom.operators import gates as G
from riskloom.operators import history as H
from riskloom.operators import metrics as M
from riskloom.operators import scaling, selection
from riskloom.operators.behaviour import deviation_from_mean, sums_between, trailing_count
from riskloom.operators.joins import insert_ignore, last_before, upsert_by_key
from riskloom.operators.prefix import running_totals

T0 = dt.datetime(2024, 1, 1)


def brute_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


def scored(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    labels = (rng.random(n) < 0.3).astype(int)
    scores = np.clip(np.round(rng.normal(0.4 + 0.2 * labels, 0.2), 2), 0, 1)
    scores[: n // 3] = 0.5  # a third of all rows share one score
    return spark.createDataFrame(list(zip(scores.tolist(), labels.tolist())), "score double, is_fraud int"), scores, labels


def test_auc_against_all_pairs(spark):
    df, s, y = scored(spark)
    want = brute_auc(s, y)
    assert M.auc(df).first()[0] == pytest.approx(want, abs=1e-12)
    assert M.auc_trapezoid(df).first()[0] == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, is_fraud int")
    assert M.auc(df).first()[0] == 0.0 and M.auc(df, one_class=0.5).first()[0] == 0.5
    none = M.evaluate(df.filter("score > 1")).first()
    assert (none.precision, none.recall, none.f1, none.auc_roc, none.tp) == (0.0, 0.0, 0.0, 0.0, 0)


def test_evaluate_and_sweep(spark):
    df, s, y = scored(spark)
    m = M.evaluate(df, threshold=0.5, accuracy=True).first()
    hit = s > 0.5
    assert (m.tp, m.fp, m.fn, m.tn) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()), int((~hit & (y == 1)).sum()), int((~hit & (y == 0)).sum()))
    assert m.accuracy == pytest.approx((hit == (y == 1)).mean())
    for inclusive in (True, False):
        for r in M.threshold_sweep(df, M.grid(*M.SWEEP_GRID), inclusive=inclusive).collect():
            hit = s >= r.threshold if inclusive else s > r.threshold
            assert (r.tp, r.fp) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()))


def test_best_threshold_falls_back(spark):
    df = spark.createDataFrame([(0.01, 1), (0.02, 0)], "score double, is_fraud int")
    sweep = M.threshold_sweep(df, M.grid(*M.BEST_F1_GRID))
    assert M.best_f1(sweep).first().threshold == 0.5 and M.feasible(sweep).first()[0] is False


def test_running_totals_in_groups(spark):
    rng = np.random.default_rng(5)
    rows = [("a" if i % 3 else "b", float(v), 1) for i, v in enumerate(rng.integers(0, 40, 500))]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    for parts in (1, 7):
        for r in running_totals(df, "v", ["n"], ["g"], parts=parts).collect():
            assert r.n_before == sum(1 for g, v, _ in rows if g == r.g and v < r.v)
        for r in running_totals(df, "v", ["n"], ["g"], descending=True, parts=parts).collect():
            assert r.n_before == sum(1 for g, v, _ in rows if g == r.g and v > r.v)


@pytest.mark.parametrize("limit", [3, 50, 10_000])
def test_exact_order_values(spark, monkeypatch, limit):
    monkeypatch.setattr(selection, "BRACKET_LIMIT", limit)
    rng = np.random.default_rng(7)
    a = rng.normal(size=401)
    b = np.where(rng.random(401) < 0.5, 0.0, np.where(rng.random(401) < 0.5, 0.5, rng.random(401)))
    rows = [(float(x), None if i % 10 == 0 else float(y), None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = selection.exact_medians(df, ["a", "b", "c"])
    assert got["a"] == pytest.approx(np.median(a)) and got["c"] is None
    assert got["b"] == pytest.approx(np.median([y for i, y in enumerate(b) if i % 10]))
    ranks = [0, 1, 100, 200, 399, 400]
    assert selection.order_values(df, [("a", r) for r in ranks], {"a": 401}) == pytest.approx(list(np.sort(a)[ranks]))
    assert selection.impute_median(df, ["b", "c"]).filter("b IS NULL").count() == 0


def test_head_split(spark):
    df = spark.range(0, 2001, 2).withColumnRenamed("id", "k").repartition(5)
    out = selection.head_split(df, "k")
    assert out.filter("split = 'train'").count() == int(1001 * 0.7)
    assert out.filter("split = 'train'").agg(F.max("k")).first()[0] < out.filter("split = 'val'").agg(F.min("k")).first()[0]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k for r in selection.sample_rows(df.repartition(7), "k", 100).collect()}
    assert a == {r.k for r in selection.sample_rows(df.coalesce(1), "k", 100).collect()} and len(a) == 100


def test_scaling_modes(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    p = scaling.fit_minmax(df, ["a", "c"])
    got = {m: [tuple(r) for r in scaling.apply_minmax(df, p, m).collect()] for m in ("zero", "keep", "eps")}
    assert got["zero"] == [(0.0, 0.0), (1.0, 0.0)] and got["keep"] == [(0.0, 5.0), (1.0, 5.0)]
    assert got["eps"][1][0] == pytest.approx(1.0, abs=1e-7) and got["eps"][1][1] == 0.0


@pytest.mark.parametrize("slices", [1, 4, 720])
def test_trailing_count(spark, slices):
    rng = np.random.default_rng(11)
    seconds = np.concatenate([rng.integers(0, 30_000, 300), np.full(60, 7200), np.full(40, 10_800)])
    users = np.where(rng.random(400) < 0.6, 1, rng.integers(2, 9, 400))  # one busy user
    rows = [(i, int(u), T0 + dt.timedelta(seconds=int(s))) for i, (u, s) in enumerate(zip(users, seconds))]
    df = spark.createDataFrame(rows, "id int, u int, ts timestamp_ntz")
    got = {r.id: r.velocity_1h for r in trailing_count(df, "u", "ts", 3600, slices=slices).collect()}
    for i in range(400):
        want = int(((users == users[i]) & (seconds <= seconds[i]) & (seconds >= seconds[i] - 3600)).sum())
        assert got[i] == want


def test_sums_between_slices(spark):
    """Totals over a long history against plain sums, with gaps and negative slices."""
    rng = np.random.default_rng(5)
    slices = {k: np.sort(rng.choice(np.arange(-400, 1200), size=500, replace=False)) for k in ("a", "b")}
    rows = [(k, int(s), int(rng.integers(1, 9))) for k, own in slices.items() for s in own] + [(None, 3, 1), (None, 4, 1)]
    totals = spark.createDataFrame(rows, "u string, _s long, _n long")
    for lag in (1, 2, 7, 720):
        got = {(r._key, r._slice): r._between for r in sums_between(totals, "u", lag).collect()}
        assert got == {(k, s): sum(n for j, t, n in rows if j == k and s - lag < t < s) for k, s, _ in rows}


def test_no_window_holds_a_whole_key(spark):
    df = spark.createDataFrame([(1, 1, T0)], "id int, u int, ts timestamp_ntz")
    plan = trailing_count(df, "u", "ts", 3600)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[.*\], \[([^\]]*)\], \[[^\]]*\]\n", plan)
    assert windows and all("," in keys for keys in windows)


def test_trailing_count_of_null_keys_and_times(spark):
    rows = [(1, None, T0), (2, None, T0 + dt.timedelta(seconds=1800)), (3, 1, None), (4, 1, T0)]
    df = spark.createDataFrame(rows, "id int, u int, ts timestamp_ntz")
    got = {r.id: r.velocity_1h for r in trailing_count(df, "u", "ts", 3600).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1}


def test_deviation_without_spread(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 0.0), (2, 100.0)], "u int, v double")
    assert sorted(r.amount_deviation for r in deviation_from_mean(df, "u", "v").collect()) == [0.0, 0.0, 1.0, 1.0]


def test_insert_ignore_and_upsert(spark):
    schema = "partition int, offset bigint, payload string"
    old = spark.createDataFrame([(0, 1, "a")], schema)
    new = spark.createDataFrame([(0, 1, "x"), (1, 1, "b"), (1, 1, "c"), (0, 2, "d")], schema)
    got = sorted(tuple(r) for r in insert_ignore(old, new, ["partition", "offset"]).collect())
    assert got == [(0, 2, "d"), (1, 1, "b")]
    t = spark.createDataFrame([("k", 1, 5), ("m", 2, 5)], "id string, v int, at int")
    n = spark.createDataFrame([("k", 9, 1), ("z", 3, 1)], "id string, v int, at int")
    assert sorted(tuple(r) for r in upsert_by_key(t, n, "id", "at").collect()) == [("k", 9, 1), ("m", 2, 5), ("z", 3, 1)]


def run_rows(spark, rows):
    full = [(d, i, T0 + dt.timedelta(days=day), None if end is None else T0 + dt.timedelta(days=end), state, lines) for d, i, day, end, state, lines in rows]
    return spark.createDataFrame(full, "dag_id string, run_id long, execution_date timestamp_ntz, end_date timestamp_ntz, state string, has_error_lines boolean")


def test_run_states(spark):
    runs = run_rows(spark, [
        ("again", 1, 1, 1, "failed", True), ("again", 2, 2, 2, "failed", True),
        ("new", 3, 1, 1, "success", True), ("new", 4, 2, None, "failed", True),
        ("first", 5, 9, 9, "failed", True),
        ("fixed", 6, 1, 1, "failed", True), ("fixed", 7, 2, 2, "success", True),
        ("fine", 8, 1, 1, "success", True), ("busy", 9, 1, 1, "failed", True), ("busy", 10, 2, 2, "running", True),
        ("silent", 11, 2, 2, "failed", False), ("old", 12, 1, 1, "failed", True), ("old", 13, 2, 2, "success", True), ("old", 14, 3, 3, "success", True),
    ])
    states = H.run_states(runs)
    assert {r.dag_id: (r.run_id, r.failure_type) for r in states.collect()} == {
        "again": (2, "Recurring Failure"), "new": (4, "New Failure"), "first": (5, "New Failure"), "fixed": (6, "Resolved Failure")
    }
    assert tuple(H.failure_totals(states).first()) == (4, 3, 1)
    ordered = H.failures_latest_first(states).collect()
    assert ordered[0].dag_id == "first" and [r.is_latest for r in ordered] == [True, False, False, False]


def test_regressions(spark):
    now = spark.createDataFrame([("a", 8.0), ("b", 9.95), ("c", 5.0), ("d", 9.0)], "dag_id string, score double")
    old = spark.createDataFrame([("a", "8.05"), ("c", "n/a"), ("d", "9.2")], "dag_id string, score string")
    got = {r.dag_id: r.previous_score for r in H.score_regressions(now, old).collect()}
    assert got == {"c": 10.0, "d": 9.2}
    assert H.overall_score(now.filter("score > 99")).first()[0] == 10.0
    assert H.overall_score(now.select(F.when(F.col("dag_id") != "a", F.col("score")).alias("score"))).first()[0] == pytest.approx(23.95 / 4)


def test_concurrency_against_expansion(spark):
    rng = np.random.default_rng(2)
    spans = []
    for i in range(400):
        start = T0 + dt.timedelta(seconds=int(rng.integers(0, 20_000)))
        end = None if i % 20 == 0 else start + dt.timedelta(seconds=int(rng.integers(-120, 3000)))
        spans.append((f"d{0 if i % 3 == 0 else int(rng.integers(1, 14)):02d}", start, end))
    points = {}
    for d, s, e in spans:
        t = s.replace(second=0)
        while e is not None and t <= e:
            points[(t, d)] = points.get((t, d), 0) + 1
            t += dt.timedelta(minutes=1)
    totals = {}
    for (t, d), n in points.items():
        totals[d] = totals.get(d, 0) + n
    top = [d for d, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:10]]
    want = {}
    for (t, d), n in points.items():
        k = (t, d if d in top else "others")
        want[k] = want.get(k, 0) + n
    loads = C.by_minute(spark.createDataFrame(spans, "dag_id string, start_date timestamp_ntz, end_date timestamp_ntz"))
    assert {(r.minute, r.dag_group): r.load for r in loads.collect()} == want
    per_minute = {}
    for (t, _), n in want.items():
        per_minute[t] = per_minute.get(t, 0) + n
    best = max(per_minute.values())
    p = C.peak(loads).first()
    assert (p.peak_load, p.peak_at) == (best, min(t for t, n in per_minute.items() if n == best))


def registry(spark, rows):
    return spark.createDataFrame(rows, "version string, status string, created int")


def test_registry_transitions(spark):
    reg = registry(spark, [("v1", "retired", 1), ("v2", "champion", 2), ("v3", "challenger", 3)])
    state = lambda df: {r.version: r.status for r in df.collect()}
    assert state(G.promote(reg, "PASS")) == {"v1": "retired", "v2": "retired", "v3": "champion"}
    assert state(G.promote(reg, "FAIL")) == {"v1": "retired", "v2": "champion", "v3": "retired"}
    only = G.promote(registry(spark, [("v1", "challenger", 1)]), "FAIL").first()
    assert (only.status, only.action) == ("challenger", "NO_CHAMPION_TO_RESTORE")
    assert state(G.promote(registry(spark, [("v2", "champion", 2)]), "PASS")) == {"v2": "champion"}


def test_gates(spark):
    good = spark.createDataFrame([(0.5, 0.4, 0.45, 0.78)], "precision double, recall double, f1 double, auc_roc double")
    assert G.gate_result(good).first()[0] == "PASS"
    assert G.gate_result(good.drop("auc_roc")).first()[0] == "FAIL"
    assert G.gate_result(good.filter("f1 > 2")).first()[0] == "PASS"
    record = spark.createDataFrame([(0.34,)], "health_score double")
    off = G.health_gate(record, None)
    assert off.first().status == "DISABLED"
    assert G.gated(spark.range(3), G.gate_result(good), off).count() == 0
    assert G.gated(spark.range(3), G.gate_result(good), G.health_gate(None, spark.range(1))).count() == 3


def test_rows_without_score_stay_in_the_counts(spark):
    rows = spark.createDataFrame([(None, 1), (0.9, 1), (0.2, 0), (None, 0), (0.7, None)], "score double, is_fraud int")
    c = M.confusion(rows).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (1, 1, 1, 2)
    e = M.evaluate(rows).first()
    assert (e.tp, e.fp, e.fn, e.tn, e.recall) == (1, 1, 1, 2, 0.5)
    for r in M.threshold_sweep(rows, [0.5, 0.8]).collect():
        assert r.tp + r.fp + r.fn + r.tn == 5


def test_median_skips_missing_numbers(spark):
    rows = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, float("nan"), float("nan"), float("nan"), None)], "x double")
    from riskloom.operators.selection import exact_medians

    assert exact_medians(rows, ["x"]) == {"x": 2.0}


def test_only_one_failure_is_the_latest(spark):
    rows = [("a", 1, "2024-01-02"), ("a", 2, "2024-01-02"), ("b", 3, "2024-01-01")]
    df = spark.createDataFrame(rows, "dag_id string, run_id long, t string").selectExpr(
        "dag_id", "run_id", "cast(t as timestamp_ntz) AS end_date", "cast(t as timestamp_ntz) AS execution_date"
    )
    assert [r.is_latest for r in H.failures_latest_first(df).collect()] == [True, False, False]


def test_default_health_without_any_table(spark):
    row = G.health_gate(None, None).first()
    assert (row.health_score, row.status) == (0.75, "ENABLED")


def test_average_ranks(spark):
    scores = [0.3, None, 0.0, -0.0, 0.7, 0.3, float("nan"), 0.3, -1.0, float("nan"), None, 2.0]
    df = spark.createDataFrame(list(enumerate(scores)), "id int, score double").repartition(5)
    got = {r.id: r.avg_rank for r in M.average_ranks(df).collect()}
    key = [0.0 if s is None else np.inf if s != s else s for s in scores]
    assert got == {
        i: sum(k < own for k in key) + (sum(k == own for k in key) + 1) / 2 for i, own in enumerate(key)
    }
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 3000).alias("score"))
    ranks = M.average_ranks(hot)
    assert ranks.agg(F.sum("avg_rank")).first()[0] == 3000 * 3001 / 2
    assert ranks.filter("score = 0.5").select("avg_rank").distinct().count() == 1
    assert M.average_ranks(df.limit(0)).count() == 0


def test_one_scan_for_average_ranks(spark, sf):
    from riskloom.plans.metrics import avg_rank

    plan = avg_rank(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "events.parquet" not in plan and "Join Inner" not in plan.split("Join LeftOuter")[0]


def test_long_spans_are_cut_into_ranges(spark):
    """A span over days, one without changes inside, and many short ones; counted minute by minute."""
    minute = dt.timedelta(minutes=1)
    spans = [("a", T0, T0 + 4000 * minute), ("b", T0 + 10 * minute, T0 + 10 * minute)]
    spans += [("a", T0 + k * 37 * minute, T0 + (k * 37 + 20) * minute) for k in range(60)]
    spans += [("b", T0 - 3000 * minute, T0 - 1000 * minute), ("c", T0, T0 - minute), ("c", T0, None)]
    df = spark.createDataFrame(spans, "dag_id string, start_date timestamp_ntz, end_date timestamp_ntz")
    want = {}
    for dag, first, last in spans:
        if last is not None and last >= first:
            m = first.replace(second=0, microsecond=0)
            while m <= last:
                want[m, dag] = want.get((m, dag), 0) + 1
                m += minute
    got = {(r.minute, r.dag_group): r.load for r in C.by_minute(df).collect()}
    assert got == want
    plan = C.by_minute(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(sequence(at") == 1


def test_last_event_before(spark):
    rng = np.random.default_rng(2)
    events = [(int(k), T0 + dt.timedelta(hours=int(h)), i, f"e{i}") for i, (k, h) in enumerate(zip(rng.integers(0, 3, 80), rng.integers(0, 400, 80)))]
    events += [(None, T0, 900, "no key"), (1, None, 901, "no time")]
    rows = [(int(k), T0 + dt.timedelta(hours=int(h)), j) for j, (k, h) in enumerate(zip(rng.integers(0, 5, 120), rng.integers(-20, 430, 120)))]
    rows += [(None, T0, 500), (1, None, 501), rows[0]]
    left = spark.createDataFrame(rows, "k int, at timestamp_ntz, id int")
    right = spark.createDataFrame(events, "k int, started timestamp_ntz, n int, name string")
    for seconds in (3600, 86_400, 10**7):
        got = last_before(left, right, "k", "at", "started", "n", slice_seconds=seconds)
        assert got.columns == ["k", "at", "id", "last"]
        found = sorted((r.id, r.last.name if r["last"] else None) for r in got.collect())
        want = []
        for k, at, i in rows:
            past = [(s, n, name) for j, s, n, name in events if k is not None and at is not None and j == k and s is not None and s <= at]
            want.append((i, max(past)[2] if past else None))
        assert found == sorted(want)


def test_issues_with_their_last_run(spark):
    runs = [("d", T0, 1, "success", T0 + dt.timedelta(hours=1)), ("d", T0 + dt.timedelta(days=1), 2, "running", None),
            ("d", T0 + dt.timedelta(days=2), 3, "failed", None)]
    issues = [("d", T0 - dt.timedelta(hours=1)), ("d", T0 + dt.timedelta(days=1)), ("d", T0 + dt.timedelta(days=3)), ("e", T0)]
    got = H.with_last_run(
        spark.createDataFrame(issues, "dag_id string, check_timestamp timestamp_ntz"),
        spark.createDataFrame(runs, "dag_id string, execution_date timestamp_ntz, run_id int, state string, end_date timestamp_ntz"),
    )
    assert sorted((r.dag_id, r.check_timestamp, r.result_of_last_run, r.time_of_last_run) for r in got.collect()) == [
        (*issues[0], "no_history", None), (*issues[1], "success", T0 + dt.timedelta(hours=1)), (*issues[2], "failed", None),
        (*issues[3], "no_history", None),
    ]


@pytest.mark.parametrize("gate,health,want", [("PASS", 0.3, [0.2]), ("PASS", 0.5, [0.2, 0.35]), ("FAIL", 0.9, []), ("PASS", None, [0.2, 0.35])])
def test_rows_under_several_limits(spark, gate, health, want):
    record = spark.createDataFrame([(health,)], "health_score double") if health else None
    got = G.gated_by_limits(spark.range(2), spark.createDataFrame([(gate,)], "gate string"), record, [0.35, 0.2])
    assert sorted(r.health_limit for r in got.collect()) == sorted(want * 2)
