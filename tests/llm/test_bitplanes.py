import hashlib
import math

import numpy as np
import pytest

from riskloom.llm import bitplanes


def plain(rows, k=16, rounds=3):
    """Lloyd's rounds in Python integers."""
    kept = [
        (i, [max(-bitplanes.LIMIT, min(bitplanes.LIMIT, math.floor(64 * x))) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    def place(row):  # rows of one id: by their planes
        name = f"1:{'' if row[0] is None else row[0]}"
        return hashlib.sha256(name.encode()).hexdigest(), bitplanes.planes_of(np.array([row[1]]))[0].tobytes()

    order = sorted(kept, key=place)
    centroids = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, v, apart.index(min(apart)), min(apart)))
        return out

    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            own = [v for _, v, c, _ in near if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = {n: sum(d for *_, c, d in near if c == n) for n in range(len(centroids))}
    return sorted((
        (i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for i, _, c, d in near
    ), key=repr)


def run(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return sorted((tuple(r) for r in bitplanes.cluster(frame).collect()), key=repr)


@pytest.mark.parametrize("top", [0, 1, 5, 300, bitplanes.LIMIT])
def test_popcounts_are_dot_products(top):
    rng = np.random.default_rng(top)
    a, b = rng.integers(-top - 1, top + 1, (50, 64)), rng.integers(-top // 3 - 1, top + 1, (9, 64))
    a, b = np.clip(a, -bitplanes.LIMIT, bitplanes.LIMIT), np.clip(b, -bitplanes.LIMIT, bitplanes.LIMIT)
    planes, centres = bitplanes.planes_of(a), bitplanes.planes_of(b)
    assert (bitplanes.dots(planes, centres) == a @ b.T).all()
    assert (bitplanes.norms(planes) == (a * a).sum(axis=1)).all()
    best, distance = bitplanes.nearest(planes, centres)
    apart = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    cluster = best % 3
    sums = bitplanes.sums_of(planes, cluster, 3)
    assert (sums == np.array([a[cluster == k].sum(axis=0) for k in range(3)])).all()


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2 + i % 3, 64)]) for i in range(300)]
    assert run(spark, rows) == plain(rows)


def test_double_components_are_not_rounded(spark):
    rows = [(i, [math.nextafter((i + k) / 64, -1) if k % 2 else (i + k) / 64 for k in range(64)]) for i in range(30)]
    assert run(spark, rows, "double") == plain(rows)


def test_odd_vectors(spark):
    good = [0.25] * 64
    rows = [
        (1, good), (2, None), (3, []), (4, good[:63]), (5, good + [0.0]), (6, [None] + good[1:]), (7, [math.nan] + good[1:]),
        (8, [math.inf] + good[1:]), (9, [0.0] * 64), (10, [-0.01] * 64), (None, good), (1, good), (1, [0.5] * 64),
        (11, [3e38] + good[1:]), (12, [-3e38] * 64), (13, [1.0] * 64),
    ]
    got = run(spark, rows)
    assert got == plain(rows)
    assert sorted({r[0] for r in got}, key=repr) == sorted([1, 9, 10, 11, 12, 13, None], key=repr)


def test_ties_and_hot_group(spark):
    rows = [(i, [1.0] * 64) for i in range(400)] + [(1000 + i, [float(i % 2)] * 64) for i in range(50)]
    got = run(spark, rows)
    assert got == plain(rows)
    assert {r[1] for r in got if r[0] < 400} == {min(r[1] for r in got if r[0] < 400)}


def test_empty_and_unfit_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0]), (2, None)]) == []
    assert run(spark, [(1, [1.0] * 64)]) == plain([(1, [1.0] * 64)])


def test_sums_beyond_64_bits(spark):
    assert bitplanes.fitting(2**63 - 1) == 2**63 - 1 and bitplanes.fitting(2**63) is None


def test_other_columns(spark):
    frame = spark.createDataFrame(
        [(1, [1.0] * 64, "x", 2)], "vec_id long, embedding array<float>, cluster string, planes int"
    )
    assert bitplanes.cluster(frame).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    ]
