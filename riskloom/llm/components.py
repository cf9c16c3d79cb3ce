"""Connected components of a distributed edge list, and work on groups that are split into blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Large and small stars by turns: each round hangs neighbours on the least node they know, by a minimum per node (a
    partial aggregation) and one equi-join, until nothing changes. Every round's edges are written to the shared folder,
    so the lineage stays short and lost executors cost one round. Loops and repeated edges do no harm.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    held = materialize(links, "edges")
    known = mark(held)
    while True:
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        held = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = mark(held)
        if now == known:
            break
        known = now
    tops = held.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def mark(links: DataFrame) -> tuple:
    """A fingerprint of an edge list."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def block_pairs(rows: DataFrame, group: list[str], size: str, member: str, block: int) -> DataFrame:
    """The rows once per pair of blocks that they belong to: a group of ``size`` members is cut into blocks of about
    ``block`` members, and each pair of its blocks (also a block with itself) becomes a group of bounded size.

    Adds ``bi``, ``bj`` and ``own`` (the row's block). Groups of one block are not copied.
    """
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(member), n).cast("int")
    placed = rows.withColumns({"_n": n, "own": own})
    others = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return others.withColumns({"bi": F.least("own", "_other"), "bj": F.greatest("own", "_other")}).drop("_n", "_other")


def local_components(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the least index that each index reaches."""
    n = len(linked)
    linked = linked | np.eye(n, dtype=bool)
    label = np.arange(n)
    while True:
        new = np.where(linked, label[None, :], n).min(axis=1)
        if (new == label).all():
            return label
        label = new


def across(linked: np.ndarray, own: np.ndarray, bi: int, bj: int) -> np.ndarray:
    """For a pair of different blocks only links between the two count: those inside are another group's work."""
    return linked if bi == bj else linked & (own[:, None] != own[None, :])


def edge_batch(a: np.ndarray, b: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(links)], ["a", "b", "links"])


def by_group(
    batches: Iterator[pa.RecordBatch], keys: int, work: Callable[[pa.Table], list[pa.RecordBatch]],
) -> Iterator[pa.RecordBatch]:
    """Hand tables of whole groups to ``work``: rows come sorted by their first ``keys`` columns, and the last group of
    a batch waits for the next one."""
    left: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if left is not None:
            table = pa.concat_tables([left, table])
        last = last_group(table, keys)
        if last:
            yield from work(table.slice(0, last))
        left = table.slice(last)
    if left is not None and left.num_rows:
        yield from work(left)


def starts_of(table: pa.Table, keys: int) -> np.ndarray:
    """Where the groups of a sorted table start."""
    change = np.zeros(table.num_rows, dtype=bool)
    change[:1] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def last_group(table: pa.Table, keys: int) -> int:
    return int(starts_of(table, keys)[-1])
