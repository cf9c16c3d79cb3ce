"""Near-duplicate vectors by hashing random projections to points of the E8 lattice, verified by cosine."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import across, block_pairs, by_group, components, edge_batch, local_components, starts_of
from riskloom.llm.shingles import mix
from riskloom.session import materialize

SIMILARITY = 0.98
TABLES = 6
#: Lattice points next to the nearest one that are probed as well.
PROBES = 6
#: The projected distance of two vectors at the least similarity, in units in which lattice points are at least
#: the root of 2 apart. Per table about nine tenths of such pairs then meet in a probed cell.
SPREAD = 0.35
BLOCK = 1024
SEED = 8


@functools.cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of the lattice."""
    whole = [
        [a if k == i else b if k == j else 0.0 for k in range(8)]
        for i, j in itertools.combinations(range(8), 2) for a in (1.0, -1.0) for b in (1.0, -1.0)
    ]
    half = [signs for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(whole + half)


def nearest_even(points: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    near = np.rint(points)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    away = points[odd] - near[odd]
    worst = np.abs(away).argmax(axis=1)
    line = np.arange(len(odd))
    near[odd, worst] += np.where(away[line, worst] >= 0, 1.0, -1.0)
    return near


def nearest(points: np.ndarray) -> np.ndarray:
    """The nearest lattice points: whole coordinates, or all halves."""
    whole, half = nearest_even(points), nearest_even(points - 0.5) + 0.5
    closer = ((points - half) ** 2).sum(axis=1) < ((points - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


@functools.cache
def projection(size: int, table: int) -> np.ndarray:
    """Eight orthonormal directions (as many as there are for shorter vectors)."""
    top = max(size, 8)
    square = np.linalg.qr(np.random.default_rng([SEED, size, table]).standard_normal((top, top)))[0]
    return square[:size, :8]


def cells_of(units: np.ndarray, similarity: float) -> np.ndarray:
    """(vectors, TABLES, 1 + PROBES) cell codes; the first of a table is the vector's own, the others are the lattice
    points next to it that lie closest to the projection."""
    n, size = units.shape
    radius = np.sqrt(max(2.0 - 2.0 * similarity, 1e-6)) * np.sqrt(min(1.0, 8 / size))
    out = np.zeros((n, TABLES, 1 + PROBES), dtype=np.uint64)
    shift = np.random.default_rng([SEED, 0]).uniform(0, 1, (TABLES, 8))
    scale = mix(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
    for t in range(TABLES):
        points = units @ projection(size, t) * (SPREAD / radius) + shift[t]
        own = nearest(points)
        near = (points - own) @ neighbours().T
        best = np.argpartition(-near, PROBES - 1, axis=1)[:, :PROBES]
        probed = np.concatenate([own[:, None, :], own[:, None, :] + neighbours()[best]], axis=1)
        whole = np.rint(2 * probed).astype(np.int64).view(np.uint64)
        out[:, t] = mix((whole * scale).sum(axis=2, dtype=np.uint64) + np.uint64(t + 1))
    return out


def units_of(raw: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1).astype(np.float64)
    return vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label and ``raw``: the vector as 32-bit floats, null unless all are finite and not all zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for row in batch.column(2).to_pylist():
                vector = np.array(row if row and None not in row else [], dtype=np.float32) + np.float32(0)
                raw.append(vector.tobytes() if len(vector) and np.isfinite(vector).all() and vector.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names)

    names = ["vec_id", "label", "raw"]
    chosen = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast("array<float>")
    )
    return chosen.mapInArrow(run, "vec_id bigint, label bigint, raw binary")


def cell_rows(classes: DataFrame, similarity: float) -> DataFrame:
    """(cell, node, own_cell) of every class: its own cells and the probed ones. The cell's code includes the label and
    the vector's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw = batch.column(2).to_pylist()
            sizes = np.array([len(r) for r in raw])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                cells = grouped_cells(cells_of(units_of([raw[k] for k in at]), similarity), label[at], size)
                own = np.zeros(cells.shape, dtype=bool)
                own[:, :, 0] = True
                ids = np.repeat(node[at], cells.shape[1] * cells.shape[2])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.ravel().view(np.int64)), pa.array(ids), pa.array(own.ravel())],
                    ["cell", "node", "own_cell"],
                )

    return classes.select("node", "label", "raw").mapInArrow(run, "cell bigint, node bigint, own_cell boolean")


def grouped_cells(cells: np.ndarray, label: np.ndarray, size: int) -> np.ndarray:
    return mix(cells + mix(label.astype(np.int64).view(np.uint64) + np.uint64(size) * np.uint64(1 << 40))[:, None, None])


def first_meeting(cells: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of rows the least cell in which they meet: the own cell of one, own or probed by the other."""
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for t in range(cells.shape[1]):
        for x, y in ((a, b), (b, a)):
            own = cells[x, t, 0]
            meets = (cells[y, t] == own[:, None]).any(axis=1)
            least = np.where(meets, np.minimum(least, own), least)
    return least


def cell_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Of each group (cell, bi, bj): (a, b, links) with the number of links of a counted here (b = a), and edges (links
    = 0) that connect what is linked here. A pair that meets in several cells counts in the least of them only."""
    def work(table: pa.Table) -> list[pa.RecordBatch]:
        cell, bi, bj = (table.column(c).to_numpy() for c in ("cell", "bi", "bj"))
        own, node, size = (table.column(c).to_numpy() for c in ("own", "node", "size"))
        label, own_cell = table.column("label").to_numpy(), table.column("own_cell").to_numpy()
        raw = table.column("raw").to_pylist()
        starts, out = starts_of(table, 3), []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)]):
            if e - s < 2 or not own_cell[s:e].any():
                continue
            units = units_of(raw[s:e])
            linked = (units @ units.T >= similarity) & (own_cell[s:e, None] | own_cell[None, s:e])
            linked = across(linked, own[s:e], bi[s], bj[s]) & ~np.eye(e - s, dtype=bool)
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            cells = grouped_cells(cells_of(units, similarity), label[s:e], len(raw[s]))
            counts = np.zeros(e - s, dtype=np.int64)
            for i in range(0, len(a), 200_000):
                x, y = a[i : i + 200_000], b[i : i + 200_000]
                here = first_meeting(cells, x, y).view(np.int64) == cell[s]
                counts += np.bincount(x[here], size[s:e][y[here]], e - s).astype(np.int64)
            top = local_components(linked)
            for at, other, n in ((np.flatnonzero(counts), np.arange(e - s), counts),
                                 (np.flatnonzero(top != np.arange(e - s)), top, np.zeros(e - s, dtype=np.int64))):
                out.append(edge_batch(node[s:e][at], node[s:e][other[at]], n[at]))
        return out

    columns = ["cell", "bi", "bj", "own", "node", "size", "label", "own_cell", "raw"]
    dealt = rows.select(*columns).repartition("cell", "bi", "bj").sortWithinPartitions("cell", "bi", "bj")
    return dealt.mapInArrow(lambda batches: by_group(batches, 3, work), "a bigint, b bigint, links bigint")


def deduplicate(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label).

    Vectors are compared only when their labels are equal and not null, by cosine in double precision. Equal vectors of
    a label form a class, which goes through the hashing once. Each table projects a vector to eight dimensions and
    decodes it to the nearest E8 point; two classes are candidates if one's cell is that of the other or one of the
    other's probed neighbours in any table. Cells of one class are dropped, crowded ones cut into pairs of blocks; all
    candidates are verified, and neither links nor pairs leave a task, only counts and a spanning forest.

    Null, empty or zero vectors, vectors with null or non-finite components, null labels and null vec_ids are linked
    with nothing; vectors of different length are not compared. Rows of one vec_id are one vector in components. An
    empty table gives no rows; other columns are ignored.
    """
    rows = materialize(prepared(vectors), "vectors")
    usable = rows.filter("raw IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL")
    classes = materialize(usable.groupBy("label", "raw").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("size")
    ), "classes")
    placed = cell_rows(classes, similarity)
    shared = placed.groupBy("cell").agg(F.count("*").alias("held")).filter("held > 1")
    filled = placed.join(shared, "cell").join(classes, "node")
    found = materialize(cell_links(block_pairs(filled, ["cell"], "held", "node", BLOCK), similarity), "links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    joined = components(found.filter("links = 0 AND a <> b"))
    summary = classes.join(counts, "node", "left").join(joined, "node", "left").select(
        "label", "raw", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )
    return rows.join(summary, ["label", "raw"], "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
