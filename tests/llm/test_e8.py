import math

import numpy as np
import pytest

from riskloom.llm import e8


def test_nearest_point_against_neighbours():
    rng = np.random.default_rng(0)
    points = rng.normal(0, 3, (500, 8))
    near = e8.nearest(points)
    doubled = np.rint(2 * near)
    assert np.allclose(doubled, 2 * near)
    assert all(len(set(np.abs(d) % 2)) == 1 for d in doubled) and not (near.sum(axis=1) % 2).any()
    best = ((points - near) ** 2).sum(axis=1)
    assert (best <= 1 + 1e-9).all()  # the covering radius
    for step in e8.neighbours():
        assert (best <= ((points - near - step) ** 2).sum(axis=1) + 1e-9).all()
    assert len(e8.neighbours()) == 240


def vectors():
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1, None):
        for _ in range(25):
            base = rng.normal(size=64)
            for _ in range(int(rng.integers(1, 8))):
                rows.append([(base + rng.normal(size=64) * rng.uniform(0, 0.25)).astype(np.float32).tolist(), label])
    rows += [[rows[0][0], 0], [[2 * x for x in rows[0][0]], 0], [rows[0][0], 1], [None, 0], [[], 0], [[0.0] * 64, 0],
             [[math.nan] + [1.0] * 63, 0], [[math.inf] + [1.0] * 63, 0], [[None] + [1.0] * 63, 0], [[1.0, 2.0], 0], [[1.0, 2.0], 0],
             [[1.0] * 64, None]]
    return [(k, v, label, "x", True) for k, (v, label) in enumerate(rows)]


def plain(rows):
    units = {}
    for k, v, label, *_ in rows:
        if v and label is not None and None not in v and all(map(math.isfinite, v)) and any(v):
            a = np.array(v, dtype=np.float32).astype(float)
            units[k] = (label, len(a), a / np.sqrt((a * a).sum()))
    links = {k: [j for j in units if j != k and units[j][:2] == units[k][:2] and units[j][2] @ units[k][2] >= 0.98] for k in units}
    out = {}
    for k, *_ in rows:
        reached, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        out[k] = (len(links.get(k, [])), min(reached), min(reached) == k)
    return out


@pytest.mark.parametrize("block", [3, e8.BLOCK])
def test_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(e8, "BLOCK", block)
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, raw string, kept boolean")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in e8.deduplicate(frame).collect()}
    wanted = plain(rows)
    assert len(got) == len(rows)
    assert got == wanted


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        away = rng.normal(size=64)
        away -= away @ a * a
        b = 0.98 * a + math.sqrt(1 - 0.98**2) * away / np.linalg.norm(away)
        cells = e8.cells_of(np.stack([a, b]), 0.98)
        met += any(cells[0, t, 0] in cells[1, t] or cells[1, t, 0] in cells[0, t] for t in range(e8.TABLES))
    assert met >= 396


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert e8.deduplicate(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
    got = sorted((repr(r.vec_id), r.n_links, r.component_id, r.kept) for r in e8.deduplicate(spark.createDataFrame(rows, schema)).collect())
    assert got == [("2", 2, 2, True), ("4", 2, 2, False), ("4", 2, 2, False), ("None", 0, None, True)]
