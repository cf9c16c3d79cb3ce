"""Exact nearest neighbours by cosine distance: a tree of pivots, pruned by the triangle inequality, in blocks."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

EMBEDDING_DIM = 32

# Least rows of a slot, and the slots that a table may have before they grow, up to so many values: every row is copied to
# the blocks that it meets, so slots of one size would be copied more often the larger the table is.
BLOCK_ROWS, SLOTS, BLOCK_VALUES = 8192, 4, 2**22

# Most lists of the index: their pivots go to every task.
MAX_LISTS = 16384

# Nodes whose lists are looked at for a query's first bound, and the first lists whose nearest rows give another one.
NEAR_NODES, FIRST_LISTS = 4, 512

# Queries compared at once, the least and (in shares of a slot's rows) the most of them worth a task of their own, and the
# share of open lists from which a slot's rows are compared in one product.
QUERY_ROWS, LEAST_ROWS, BLOCK_SHARE, MOSTLY_OPEN = 512, 128, 2, 0.3

# Partitions for each block of queries and slot, so that seldom many of them fall to one task.
SPREAD = 4

# Rows that queries are compared with at once, first and later (their products fit a processor's cache); cells of a table
# of queries and lists; and the share of cells from which they are computed in one product and not one by one.
FIRST_COLUMNS, COLUMNS, CELLS, DENSE = 512, 2048, 2**21, 1 / 32

# Distances closer than this many digits count as equal and are ordered by id.
TIE_DIGITS = 9
TIE = 10.0**-TIE_DIGITS


def checked_store(rows: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Rows for the vector store; a vector of another length raises an error when the rows are written."""
    ok = F.size("embedding") == dim
    message = F.format_string(f"expected {dim} values per embedding, got %d", F.size("embedding"))
    return rows.select(
        "transaction_id", F.when(ok, F.col("embedding")).otherwise(F.raise_error(message)).alias("embedding"),
        F.col("fraud_score").cast("double").alias("fraud_score"), "is_fraud",
        F.coalesce(F.col("metadata"), F.lit("{}")).alias("metadata"),
    )


def put_vectors(store: DataFrame, new: DataFrame, now: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """The store (checked rows with created_at) after an insert-or-replace of ``new`` at ``now``.

    A replaced row takes all values of the new one but keeps the time when its id first came. Two new rows of one id are
    decided by their values, so the result does not depend on the order of the rows.
    """
    values = ["embedding", "fraud_score", "is_fraud", "metadata"]
    arrived = checked_store(new, dim).withColumn("created_at", F.lit(now).cast("timestamp_ntz"))
    both = store.withColumn("_new", F.lit(0)).unionByName(arrived.withColumn("_new", F.lit(1)))
    last = F.max_by(F.struct(*values), F.struct("_new", F.xxhash64(*values))).alias("_row")
    merged = both.groupBy("transaction_id").agg(last, F.min("created_at").alias("created_at"))
    return merged.select("transaction_id", "_row.*", "created_at")


def _unit_matrix(vectors: pd.Series) -> np.ndarray:
    m = np.stack(vectors.to_numpy()).astype(np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.full_like(m, np.nan), where=n > 0)


def _best(dist: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k best columns per row, by (rounded distance, id)."""
    rounded = np.round(dist, TIE_DIGITS)
    if dist.shape[1] > 4 * k + 16:
        # What is nearer than the k-th rounded distance stays in, and of what ties with it the first ids.
        edge = np.partition(rounded, k - 1, axis=1)[:, k - 1: k]
        by_id = np.argsort(ids, kind="stable")
        tied = (rounded == edge)[:, by_id]
        rows, cols = np.nonzero(tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= k))
        less = np.nonzero(rounded < edge)
        rows, cols = np.concatenate([less[0], rows]), np.concatenate([less[1], by_id[cols]])
    else:
        rows, cols = np.nonzero(~np.isnan(rounded))
    order = np.lexsort((ids[cols], rounded[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(dist.shape[0]))
    keep = np.arange(len(rows)) - starts[rows] < k
    return rows[keep], cols[keep]


def pivots(corpus: DataFrame, lists: int) -> np.ndarray:
    """The vectors that name the lists: rows of the corpus with the least hashes of their ids."""
    some = corpus.filter(F.exists("embedding", lambda v: v != 0)).orderBy(F.xxhash64("id"), "id").limit(lists)
    rows = some.select("embedding").toPandas()  # at most MAX_LISTS vectors
    return _unit_matrix(rows["embedding"]) if len(rows) else np.zeros((0, 1))


def _chords(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Straight-line distances of unit vectors; they obey the triangle inequality, cosine distances do not."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ centres.T), 0.0))


def _widened(bound: np.ndarray) -> np.ndarray:
    """A bound on chords that keeps what ties with it and what rounding moves beyond it."""
    return np.sqrt(bound**2 + 10 * TIE) + 1e-6


@dataclass
class PivotTree:
    """Corpus rows in lists around pivots, and the lists in nodes around the first pivots.

    ``rows`` is a stage table (list, slot, id, embedding, flagged); the arrays are bounded by MAX_LISTS and go to every
    task. ``near`` holds each list's smallest distances to its pivot, of all and of the flagged rows: with a query's
    distance to the pivot they bound the query's k-th distance from above before any row is looked at.
    """

    rows: DataFrame
    centres: np.ndarray
    node_of: np.ndarray
    nodes: np.ndarray
    radius: np.ndarray
    near: np.ndarray
    flagged_near: np.ndarray
    first_slot: np.ndarray
    slots: np.ndarray
    block_rows: int

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": None}  # tasks get the arrays only

    @functools.cached_property
    def members(self) -> list[np.ndarray]:
        return [np.flatnonzero(self.node_of == j) for j in range(len(self.nodes))]

    @functools.cached_property
    def node_radius(self) -> np.ndarray:
        """How far a row of the node's lists can be from the node's pivot."""
        out = np.full(len(self.nodes), -np.inf)
        for j, lists in enumerate(self.members):
            if len(lists):
                out[j] = (_chords(self.centres[lists], self.nodes[j: j + 1])[:, 0] + self.radius[lists]).max()
        return out

    def slotted(self) -> DataFrame:
        """The rows with their slots; a crowded list's rows are spread over its slots."""
        known = self.rows.sparkSession.createDataFrame(pd.DataFrame({  # at most MAX_LISTS rows
            "list": np.arange(len(self.slots), dtype=np.int32), "_first": self.first_slot, "_n": self.slots
        }), "list int, _first bigint, _n bigint")
        return self.rows.join(F.broadcast(known), "list").withColumn(
            "slot", (F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_n"))).cast("int")
        ).drop("_first", "_n")

    def bounds(self, x: np.ndarray, k: int, near: np.ndarray, probes: int) -> np.ndarray:
        """For each unit vector an upper bound of the chord to its k-th nearest row, from the lists of its ``probes``
        nearest nodes, or from the row nearest to each of the first pivots: most often the pivot itself."""
        lists = np.isfinite(near[:, 0])
        open_nodes = np.array([lists[m].any() for m in self.members], dtype=bool)
        best = np.full((len(x), k), np.inf)
        if not open_nodes.any():
            return best[:, -1]
        far = np.where(open_nodes, _chords(x, self.nodes), np.inf)
        count = min(probes, int(open_nodes.sum()))
        chosen = np.argpartition(far, count - 1, axis=1)[:, :count]
        for j in np.unique(chosen).tolist():
            at = np.flatnonzero((chosen == j).any(axis=1))
            own = self.members[j][lists[self.members[j]]]
            reach = (_chords(x[at], self.centres[own])[:, :, None] + near[None, own]).reshape(len(at), -1)
            both = np.concatenate([best[at], reach], axis=1)
            best[at] = np.partition(both, k - 1, axis=1)[:, :k]
        first = near[:FIRST_LISTS, 0]
        if len(first) < k:
            return best.max(axis=1)
        return np.minimum(best.max(axis=1), np.partition(_chords(x, self.centres[:FIRST_LISTS]) + first, k - 1, axis=1)[:, k - 1])

    def open_lists(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) pairs of the lists that can hold a row within the bound of the vector."""
        slack = _widened(bound)
        far = _chords(x, self.nodes)
        whose, which = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for j in np.flatnonzero((far - self.node_radius <= slack[:, None]).any(axis=0)).tolist():
            at = np.flatnonzero(far[:, j] - self.node_radius[j] <= slack)
            own = self.members[j]
            rows, cols = np.nonzero(_chords(x[at], self.centres[own]) - self.radius[own] <= slack[at, None])
            whose.append(at[rows])
            which.append(own[cols])
        return np.concatenate(whose), np.concatenate(which)

    @functools.cached_property
    def by_slot(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Each node's lists in the order of their first slots, these slots, and where their lists start."""
        ordered = [own[np.argsort(self.first_slot[own], kind="stable")] for own in self.members]
        return [(own, *np.unique(self.first_slot[own], return_index=True)) for own in ordered]

    def open_slots(self, x: np.ndarray, bound: np.ndarray) -> list[np.ndarray]:
        """The slots of each vector's open lists; a few vectors at a time, as all lists may be open for all of them."""
        width, out = int((self.first_slot + self.slots).max()), []
        crowded = [(int(self.first_slot[i]), int(self.slots[i])) for i in np.flatnonzero(self.slots > 1).tolist()]
        step = max(1, min(QUERY_ROWS, CELLS // len(self.centres)))
        for s in range(0, len(x), step):
            part, slack = x[s: s + step], _widened(bound[s: s + step])
            is_open, far = np.zeros((len(part), width), dtype=bool), _chords(part, self.nodes)
            for j in np.flatnonzero((far - self.node_radius <= slack[:, None]).any(axis=0)).tolist():
                at = np.flatnonzero(far[:, j] - self.node_radius[j] <= slack)
                own, slots, starts = self.by_slot[j]
                lists = _chords(part[at], self.centres[own]) - self.radius[own] <= slack[at, None]
                is_open[at[:, None], slots] |= np.logical_or.reduceat(lists, starts, axis=1)
            for first, count in crowded:  # such a list has its slots for itself
                is_open[:, first: first + count] |= is_open[:, first: first + 1]
            out += [np.flatnonzero(row).astype(np.int32) for row in is_open]
        return out


def build_tree(
    corpus: DataFrame, k: int, flag: str | None = None, lists: int | None = None, block_rows: int = BLOCK_ROWS,
) -> PivotTree | None:
    """The tree of a corpus (id, embedding and, if named, a flag column), for searches of up to k rows; None if no row has
    a direction. Rows without one (null, empty or zero vectors) are near nothing and left out.

    There are about twice as many lists as the root of the corpus, MAX_LISTS at most, and about the root of that many
    nodes. Rows are dealt to slots of about ``block_rows``, or on larger tables of a SLOTS-th of the rows up to
    BLOCK_VALUES: small lists of a node share one, a crowded list has several.
    """
    usable = corpus.select(
        "id", "embedding",
        (F.coalesce(F.col(flag), F.lit(False)) if flag else F.lit(False)).alias("flagged"),
    ).filter(F.exists("embedding", lambda v: v != 0))
    if lists is None:
        lists = min(MAX_LISTS, max(1, round(2 * usable.count() ** 0.5)))
    centres = pivots(usable, lists)
    if not len(centres):
        return None
    nodes = centres[: max(1, round(len(centres) ** 0.5))]
    node_of = _chords(centres, nodes).argmin(axis=1)
    members = [np.flatnonzero(node_of == j) for j in range(len(nodes))]

    @F.pandas_udf("list int, away double")
    def placed(x: pd.Series) -> pd.DataFrame:
        unit = _unit_matrix(x) if len(x) else np.zeros((0, centres.shape[1]))
        place, away = np.zeros(len(unit), dtype=np.int32), np.zeros(len(unit))
        node = _chords(unit, nodes).argmin(axis=1)
        for j in np.unique(node).tolist():
            at = np.flatnonzero(node == j)
            d = _chords(unit[at], centres[members[j]])
            best = d.argmin(axis=1)
            place[at], away[at] = members[j][best], d[np.arange(len(at)), best]
        return pd.DataFrame({"list": place, "away": away})

    table = materialize(usable.withColumn("_at", placed("embedding")).select("id", "embedding", "flagged", "_at.*"), "lists")

    def smallest(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each task's counts, radii and k + 1 smallest distances per list."""
        for pdf in pdfs:
            pdf = pdf.sort_values(["list", "flagged", "away"])
            group, away = pdf["list"].to_numpy() * 2 + pdf["flagged"].to_numpy(dtype=bool), pdf["away"].to_numpy()
            which, starts, n = np.unique(group, return_index=True, return_counts=True)
            yield pd.DataFrame({
                "list": which // 2, "flagged": which % 2 == 1, "n": n, "away": away[starts + n - 1],
                "near": [away[start: start + min(held, k + 1)] for start, held in zip(starts, n)],
            })

    stats = table.select("list", "flagged", "away").mapInPandas(
        smallest, "list int, flagged boolean, n bigint, away double, near array<double>"
    ).groupBy("list", "flagged").agg(
        F.sum("n").alias("n"), F.max("away").alias("away"),
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"),
    ).collect()  # at most two rows per list
    n, radius = np.zeros(len(centres), dtype=np.int64), np.full(len(centres), -np.inf)
    near = {f: np.full((len(centres), k + 1), np.inf) for f in (False, True)}
    for row in stats:
        n[row["list"]] += row.n
        radius[row["list"]] = max(radius[row["list"]], row.away)
        near[row.flagged][row["list"], : len(row.near)] = row.near
    every = np.sort(np.concatenate([near[False], near[True]], axis=1), axis=1)[:, : k + 1]
    block_rows = max(block_rows, min(BLOCK_VALUES // centres.shape[1], -(-int(n.sum()) // SLOTS)))
    first_slot, slots = slots_of(n, node_of, block_rows)
    return PivotTree(table, centres, node_of, nodes, radius, every, near[True], first_slot, slots, block_rows)


def slots_of(sizes: np.ndarray, node_of: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First slot and number of slots of each list: neighbours in a node share a slot up to ``block_rows``."""
    first, count = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    slot, held, node = -1, 0, -1
    for at in np.argsort(node_of, kind="stable").tolist():
        own = max(1, -(-int(sizes[at]) // block_rows))
        if slot < 0 or own > 1 or held + sizes[at] > block_rows or (node_of[at] != node and held > block_rows // 2):
            slot, held = slot + 1, 0
        first[at], count[at] = slot, own
        slot, held, node = slot + own - 1, held + int(sizes[at]) if own == 1 else block_rows, int(node_of[at])
    return first, count


def visits(tree: PivotTree, queries: DataFrame, bounds: Callable) -> DataFrame:
    """One row per query and open slot: q_id, q_embedding, bound and slot, from a stage table with one row per query.

    ``bounds`` gives the bound of each unit vector; queries without a direction visit nothing.
    """
    @F.pandas_udf("bound double, slots array<int>")
    def opened(x: pd.Series) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"bound": [], "slots": []})
        unit = _unit_matrix(x)
        bound = np.concatenate([bounds(unit[s: s + QUERY_ROWS]) for s in range(0, len(unit), QUERY_ROWS)])
        return pd.DataFrame({"bound": bound, "slots": tree.open_slots(unit, bound)})

    usable = queries.select(F.col("id").alias("q_id"), F.col("embedding").alias("q_embedding")).filter(
        F.exists("q_embedding", lambda v: v != 0)
    )
    opening = materialize(usable.withColumn("_v", opened("q_embedding")).select("q_id", "q_embedding", "_v.*"), "visits")
    return opening.select("q_id", "q_embedding", "bound", F.explode("slots").alias("slot"))


def meet(tree: PivotTree, left: DataFrame, match: Callable, schema: str) -> DataFrame:
    """``match`` on each pair of a slot's rows and a block of the queries that visit it.

    Both sides of a slot are bounded: its rows by construction, its queries by hashing them to as many blocks as their
    number asks for; only then are the slot's rows copied, once per block. The pairs get more partitions than there are
    pairs, as one may take a task for seconds however few bytes it has.
    """
    # Fewer visits than the tasks could hold are spread over all cores, a few blocks each.
    cores = left.sparkSession.sparkContext.defaultParallelism
    share = F.sum("n").over(Window.partitionBy(F.lit(0))) / F.lit(SLOTS * cores)
    most = F.lit(max(1, tree.block_rows // BLOCK_SHARE))
    held = F.greatest(F.lit(min(LEAST_ROWS, tree.block_rows)), F.least(most, share))
    blocks = F.broadcast(left.groupBy("slot").agg(F.count("*").alias("n")).select(  # one row per slot
        "slot", F.ceil(F.col("n") / held).cast("int").alias("blocks")
    ))
    rows = tree.slotted().join(blocks, "slot").select(
        "slot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("id").alias("c_id"), F.col("embedding").alias("c_embedding"), "flagged", "list",
    )
    dealt = left.join(blocks, "slot").withColumn("block", F.pmod(F.xxhash64("q_id"), F.col("blocks")).cast("int"))
    width = SPREAD * (blocks.agg(F.sum("blocks")).first()[0] or 1)
    sides = [side.repartition(width, "slot", "block").groupBy("slot", "block") for side in (dealt.drop("blocks"), rows)]
    return sides[0].cogroup(sides[1]).applyInPandas(match, schema)


def _single(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vectors in single precision, and how far a product of two of them can be from the one in double precision."""
    return x.astype(np.float32), (x.shape[1] + 8) * 2.0**-23


def _exact(q: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Cosine distances of some cells in double precision."""
    out, step = np.empty(len(rows)), max(1, CELLS // q.shape[1])
    for s in range(0, len(rows), step):
        out[s: s + step] = 1.0 - np.einsum("ij,ij->i", q[rows[s: s + step]], c[cols[s: s + step]])
    return out


def _columns(n: int) -> list[tuple[int, int]]:
    """Ranges of n rows, few at first, as long as the distance that matters is not known."""
    edges = [0]
    while edges[-1] < n:
        edges.append(min(n, edges[-1] + min(COLUMNS, max(FIRST_COLUMNS, edges[-1]))))
    return list(zip(edges, edges[1:]))


def _tiles(tree: PivotTree, q: np.ndarray, lists: np.ndarray, cut: Callable) -> Iterator[tuple]:
    """Which queries of a part meet which rows of a slot, whose rows are sorted by list: (queries, start, end).

    ``cut`` gives the largest distance that still matters to each query. Only lists that can hold such a row are met, each
    by its own queries, the nearest lists first; if most lists are open, one product is cheaper than many.
    """
    which, starts = np.unique(lists, return_index=True)
    ends = np.append(starts[1:], len(lists))
    reach = _chords(q, tree.centres[which]) - tree.radius[which]
    if (reach <= _widened((2.0 * cut())**0.5)[:, None]).mean() > MOSTLY_OPEN:
        yield from ((np.arange(len(q)), start, end) for start, end in _columns(len(lists)))
        return
    for n in np.argsort(reach.min(axis=0), kind="stable").tolist():
        for start in range(starts[n], ends[n], COLUMNS):
            at = np.flatnonzero(reach[:, n] <= _widened((2.0 * cut())**0.5))
            if len(at):
                yield at, start, min(start + COLUMNS, ends[n])


def _true_cells(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a table's few true cells, in order; eight cells at a time are seen to hold none."""
    flat = table.reshape(-1)
    whole = len(flat) // 8 * 8
    cells = (np.flatnonzero(flat[:whole].view(np.uint64) != 0)[:, None] * 8 + np.arange(8)).reshape(-1)
    cells = np.concatenate([cells, np.arange(whole, len(flat))])
    return np.divmod(cells[flat[cells]], table.shape[1])


class _Nearest:
    """The k nearest rows of each query of a part among those seen so far, and the distance that a further row must not
    exceed to be one of them."""

    def __init__(self, cut: np.ndarray, k: int):
        self.cut, self.k = cut.copy(), k
        self.which, self.far = np.zeros((len(cut), k), dtype=np.int64), np.full((len(cut), k), np.inf)

    def add(self, whose: np.ndarray, which: np.ndarray, far: np.ndarray, tie: np.ndarray) -> None:
        near = far <= self.cut[whose]
        whose, which, far = whose[near], which[near], far[near]
        own = np.unique(whose)  # only their rows can change
        whose = np.concatenate([np.repeat(own, self.k), whose])
        which = np.concatenate([self.which[own].reshape(-1), which])
        far = np.concatenate([self.far[own].reshape(-1), far])
        best = _first_of_each(whose, far, tie[which], self.k).reshape(-1, self.k)
        self.which[own], self.far[own] = which[best], far[best]
        self.cut[own] = np.minimum(self.cut[own], np.round(far[best[:, -1]], TIE_DIGITS) + TIE)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        seen = np.isfinite(self.far)
        return np.nonzero(seen)[0], self.which[seen], self.far[seen]


def _nearest(
    tree: PivotTree, q: np.ndarray, q_ids: np.ndarray, cut: np.ndarray, c: np.ndarray, c_ids: np.ndarray, lists: np.ndarray,
    k: int, exclude_self: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of each query's k nearest rows of a slot, as far as they can be among its k nearest of all.

    Products in single precision tell which cells can be within a query's cut; only these are computed in double precision.
    ``cut`` has the largest distance that matters to each query, and is lowered to that of its k-th row here.
    """
    tie = np.unique(c_ids, return_inverse=True)[1]
    (q_single, error), (c_single, _) = _single(q), _single(c)
    whose, which, far = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    products = np.empty(QUERY_ROWS * COLUMNS, dtype=np.float32)
    for s in range(0, len(q) if len(c) else 0, QUERY_ROWS):
        part, own = q[s: s + QUERY_ROWS], q_ids[s: s + QUERY_ROWS]
        found = _Nearest(cut[s: s + QUERY_ROWS], k)
        for at, start, end in _tiles(tree, part, lists, lambda f=found: f.cut):
            product = products[: len(at) * (end - start)].reshape(len(at), end - start)
            np.matmul(q_single[s + at], c_single[start:end].T, out=product)
            near = product >= (1.0 - found.cut[at] - error)[:, None].astype(np.float32)
            cells = []
            if np.count_nonzero(near) > DENSE * near.size:
                many = np.flatnonzero(near.mean(axis=1) > DENSE)
                near[many] = False
                dist = 1.0 - part[at[many]] @ c[start:end].T
                if exclude_self:
                    dist[own[at[many]][:, None] == c_ids[None, start:end]] = np.inf
                rows, cols = _best(dist, tie[start:end], k)
                kept = np.isfinite(dist[rows, cols])
                cells.append((at[many[rows[kept]]], start + cols[kept], dist[rows[kept], cols[kept]]))
            rows, cols = _true_cells(near)
            rows, cols = at[rows], start + cols
            if exclude_self:
                kept = own[rows] != c_ids[cols]
                rows, cols = rows[kept], cols[kept]
            cells.append((rows, cols, _exact(part, c, rows, cols)))
            rows, cols, dist = (np.concatenate(x) for x in zip(*cells))
            if len(rows):
                found.add(rows, cols, dist, tie)
        cut[s: s + QUERY_ROWS] = found.cut
        rows, cols, dist = found.found()
        whose.append(s + rows)
        which.append(cols)
        far.append(dist)
    return np.concatenate(whose), np.concatenate(which), np.concatenate(far)


def _first_of_each(group: np.ndarray, dist: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each group, by (rounded distance, tie)."""
    order = np.lexsort((tie, np.round(dist, TIE_DIGITS), group))
    ordered = group[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else order
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[nth < k]


def search(
    tree: PivotTree, queries: DataFrame, k: int, flagged: bool = False, max_distance: float | None = None,
    exclude_self: bool = False, probes: int = NEAR_NODES,
) -> DataFrame:
    """(query_id, id, distance, flagged): a few candidates per query, among them its k nearest rows and, if asked for,
    its k nearest flagged rows. One pass over the tree serves both.
    """
    def bounds(x: np.ndarray) -> np.ndarray:
        more = k + exclude_self  # the query itself may be one of the rows behind the bound
        bound = tree.bounds(x, more, tree.near, probes)
        if flagged:
            bound = np.maximum(bound, tree.bounds(x, more, tree.flagged_near, probes))
        return bound if max_distance is None else np.minimum(bound, max(2.0 * max_distance, 0.0) ** 0.5)

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "id": [], "distance": [], "flagged": []})
        b = b.sort_values("list", kind="stable")
        q_ids, c_ids, marks = a["q_id"].to_numpy(), b["c_id"].to_numpy(), b["flagged"].to_numpy(dtype=bool)
        tie = np.unique(c_ids, return_inverse=True)[1]
        q, c, lists = _unit_matrix(a["q_embedding"]), _unit_matrix(b["c_embedding"]), b["list"].to_numpy()
        found, cut = [], _widened(a["bound"].to_numpy())**2 / 2.0
        # The flagged rows first: a row without flag that is farther than k of them is not asked for.
        for own in (np.flatnonzero(marks), np.flatnonzero(~marks)) if flagged else (slice(None),):
            x, y, far = _nearest(tree, q, q_ids, cut, c[own], c_ids[own], lists[own], k, exclude_self)
            found.append((x, own[y] if flagged else y, far))
        whose, which, far = (np.concatenate(x) for x in zip(*found))
        best = _first_of_each(whose, far, tie[which], k)
        if flagged:
            bad = np.flatnonzero(marks[which])
            best = np.union1d(best, bad[_first_of_each(whose[bad], far[bad], tie[which[bad]], k)])
        return pd.DataFrame({
            "query_id": q_ids[whose[best]], "id": c_ids[which[best]], "distance": far[best], "flagged": marks[which[best]]
        })

    schema = f"query_id {dict(queries.dtypes)['id']}, id {dict(tree.rows.dtypes)['id']}, distance double, flagged boolean"
    return meet(tree, visits(tree, queries, bounds), match, schema)


def _ranked(candidates: DataFrame, *also: str) -> Column:
    return F.row_number().over(Window.partitionBy("query_id", *also).orderBy(F.round("distance", TIE_DIGITS), "id"))


def knn_search(
    queries: DataFrame, corpus: DataFrame, k: int = 5, max_distance: float | None = None, exclude_self: bool = False,
    lists: int | None = None, probes: int = NEAR_NODES, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """k nearest corpus rows per query, both frames with (id, embedding): (query_id, id, distance, rank). Exact.

    See ``PivotTree``: what is known of a query's nearest lists bounds its k-th distance, and by the triangle inequality
    only lists whose pivot is near enough for their radius can hold a nearer row. The others are never visited.
    """
    tree = build_tree(corpus, k + exclude_self, None, lists, block_rows)
    if tree is None:
        types = f"query_id {dict(queries.dtypes)['id']}, id {dict(corpus.dtypes)['id']}"
        return queries.sparkSession.createDataFrame([], f"{types}, distance double, rank int")
    found = search(tree, queries, k, False, max_distance, exclude_self, probes).drop("flagged")
    top = found.withColumn("rank", _ranked(found)).filter(F.col("rank") <= k)
    return top if max_distance is None else top.filter(F.col("distance") <= max_distance)


def similar_cases(
    queries: DataFrame, corpus: DataFrame, k: int = 5, fraud_only: bool = False, max_distance: float | None = None, **options,
) -> DataFrame:
    """The k nearest stored cases per query, whole: query_id, rank, id, distance and the other columns of the corpus.

    ``fraud_only`` searches the cases with ``is_fraud`` only.
    """
    stored = corpus.filter("is_fraud") if fraud_only else corpus
    near = knn_search(queries, stored, k, max_distance, **options)
    return near.join(stored.drop("embedding"), "id").select(
        "query_id", "rank", "id", "distance", *[c for c in stored.columns if c not in ("id", "embedding")]
    )


def nearest_pairs(
    rows: DataFrame, n: int, block_rows: int = BLOCK_ROWS, lists: int | None = None,
) -> DataFrame:
    """The n closest pairs (id_a, id_b, distance), both orders of a pair, over all rows of different id. Exact.

    The pairs inside the slots of a ``PivotTree`` give an n-th distance. It bounds the rest: a row visits only lists that
    can hold another row within that distance, so pairs of lists further apart are never formed.
    """
    ids = dict(rows.dtypes)["id"]
    schema = f"id_a {ids}, id_b {ids}, distance double"
    tree = build_tree(rows, 1, None, lists, block_rows)
    if tree is None:
        return rows.sparkSession.createDataFrame([], schema)

    def closest(
        q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, parts: Callable, top: float
    ) -> pd.DataFrame:
        """The n closest pairs with the smaller id first, of the tiles that ``parts`` gives for some of the queries."""
        names, rank = np.unique(np.concatenate([q_ids, c_ids]), return_inverse=True)
        q_rank, c_rank = rank[: len(q_ids)], rank[len(q_ids):]
        (q_single, error), (c_single, _) = _single(q), _single(c)
        a, b, far = np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
        for s in range(0, len(q), QUERY_ROWS):
            for at, start, end in parts(s):
                near = q_single[at] @ c_single[start:end].T >= np.float32(1.0 - top - TIE - error)
                if np.count_nonzero(near) > DENSE * near.size:
                    dist = 1.0 - q[at] @ c[start:end].T
                    near &= q_rank[at][:, None] < c_rank[None, start:end]
                    if (some := np.round(dist[near], TIE_DIGITS)).size > n:
                        top = min(top, float(np.partition(some, n - 1)[n - 1]))
                    rows, cols = np.nonzero(near & (dist <= top + TIE))
                    dist, rows, cols = dist[rows, cols], at[rows], start + cols
                else:
                    rows, cols = np.divmod(np.flatnonzero(near), end - start)
                    rows, cols = at[rows], start + cols
                    kept = q_rank[rows] < c_rank[cols]
                    rows, cols = rows[kept], cols[kept]
                    dist = _exact(q, c, rows, cols)
                a, b, far = np.append(a, q_rank[rows]), np.append(b, c_rank[cols]), np.append(far, dist)
                kept = np.flatnonzero(far <= top + TIE)
                a, b, far = a[kept], b[kept], far[kept]
                if len(far) > n:
                    best = np.lexsort((b, a, np.round(far, TIE_DIGITS)))[:n]
                    a, b, far = a[best], b[best], far[best]
                    top = min(top, float(np.round(far[-1], TIE_DIGITS)))
        return pd.DataFrame({"id_a": names[a], "id_b": names[b], "distance": far})

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        unit, own = _unit_matrix(pdf["embedding"]), pdf["id"].to_numpy()

        def parts(s: int) -> Iterator[tuple]:
            at = np.arange(s, min(s + QUERY_ROWS, len(own)))
            return ((at, start, end) for start, end in _columns(len(own)))

        return closest(own, unit, own, unit, parts, np.inf)

    order = (F.round("distance", TIE_DIGITS), "id_a", "id_b")
    some = tree.slotted().groupBy("slot").applyInPandas(inside, schema).orderBy(*order).limit(n).collect()
    top = max((r.distance for r in some), default=np.inf) if len(some) == n else np.inf
    bound = (2.0 * max(top, 0.0)) ** 0.5

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id_a": [], "id_b": [], "distance": []})
        b = b.sort_values("list", kind="stable")
        q, c, lists = _unit_matrix(a["q_embedding"]), _unit_matrix(b["c_embedding"]), b["list"].to_numpy()
        cut = a["bound"].to_numpy()**2 / 2.0

        def parts(s: int) -> Iterator[tuple]:
            tiles = _tiles(tree, q[s: s + QUERY_ROWS], lists, lambda: cut[s: s + QUERY_ROWS])
            return ((s + at, start, end) for at, start, end in tiles)

        return closest(a["q_id"].to_numpy(), q, b["c_id"].to_numpy(), c, parts, top)

    found = meet(tree, visits(tree, rows, lambda x: np.full(len(x), bound)), match, schema)
    both = found.orderBy(*order).limit(n).select(
        "distance", F.inline(F.array(F.struct("id_a", "id_b"), F.struct(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"))))
    ).select("id_a", "id_b", "distance")
    return both.orderBy(*order).limit(n)


def explain_verdict(
    queries: DataFrame, corpus: DataFrame, k: int = 5, exclude_self: bool = False, lists: int | None = None,
    probes: int = NEAR_NODES, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Verdict per query from its k nearest stored cases; corpus: (id, embedding, is_fraud and what else a case holds).

    One tree and one search give the nearest cases and the nearest fraud cases. ``cases`` has the three nearest ones
    whole, with all columns of the corpus but the vector, ``similar_cases`` their ids.
    """
    kept = [c for c in corpus.columns if c not in ("id", "embedding")]
    ids = queries.select(F.col("id").alias("query_id"))
    tree = build_tree(corpus, k + exclude_self, "is_fraud", lists, block_rows)
    if tree is None:
        types = f"query_id {dict(queries.dtypes)['id']}, id {dict(corpus.dtypes)['id']}"
        found = queries.sparkSession.createDataFrame([], f"{types}, distance double, flagged boolean")
    else:
        found = search(tree, queries, k, True, None, exclude_self, probes)
    # The k nearest of all are among the k nearest of each kind, so only these are ranked again.
    few = found.withColumn("own_rank", _ranked(found, "flagged")).filter(F.col("own_rank") <= k)
    ranked = few.withColumns({"rank": _ranked(few), "fraud_rank": F.when(F.col("flagged"), F.col("own_rank"))})
    near = ranked.filter((F.col("rank") <= k) | (F.col("fraud_rank") <= k)).join(corpus.select("id", *kept), "id")
    nearest, bad = F.col("rank") <= k, F.col("fraud_rank") <= k
    case = F.struct("rank", "id", "distance", *kept)
    per_query = near.groupBy("query_id").agg(
        F.avg(F.when(nearest, F.col("is_fraud").cast("double"))).alias("confidence"),
        F.count_if(nearest).alias("total_neighbors"),
        F.min(F.when(nearest & ~F.col("is_fraud"), F.col("distance"))).alias("nearest_legit_distance"),
        F.count_if(F.coalesce(bad, F.lit(False))).alias("fraud_neighbors"),
        F.min(F.when(bad, F.col("distance"))).alias("nearest_fraud_distance"),
        F.array_sort(F.collect_list(F.when(F.col("rank") <= 3, case))).alias("cases"),
    )
    c = F.col("confidence")
    verdict = (
        F.when(c.isNull(), "NO_HISTORY").when(c >= 0.8, "CONFIRMED_FRAUD").when(c >= 0.5, "LIKELY_FRAUD")
        .when(c >= 0.3, "UNCERTAIN").otherwise("LIKELY_LEGIT")
    )
    return ids.join(per_query, "query_id", "left").select(
        "query_id", verdict.alias("verdict"), F.coalesce(c, F.lit(0.0)).alias("confidence"),
        F.coalesce("fraud_neighbors", F.lit(0)).alias("fraud_neighbors"),
        F.coalesce("total_neighbors", F.lit(0)).alias("total_neighbors"),
        "nearest_fraud_distance", "nearest_legit_distance",
        F.transform("cases", lambda x: x["id"]).alias("similar_cases"), "cases",
    )


def embedding_drift(new: DataFrame, stored: DataFrame, bound: float, **options) -> DataFrame:
    """Distance of new vectors to their nearest stored one: mean, largest, share above the bound."""
    near = knn_search(new, stored, 1, **options)
    return near.agg(
        F.count("*").alias("n"), F.avg("distance").alias("mean_distance"), F.max("distance").alias("max_distance"),
        F.avg((F.col("distance") > bound).cast("double")).alias("share_above"),
    )
