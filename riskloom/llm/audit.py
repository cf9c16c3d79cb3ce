"""What each of several filters removes in every order, with repeats found behind a counting Bloom filter."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import by_group, starts_of
from riskloom.llm.exprs import text_of
from riskloom.session import materialize

#: The filters that look at one text only; REPEAT stands for the one that looks for earlier copies.
OWN_FILTERS, REPEAT = "ABCD", "E"
FILTERS = OWN_FILTERS + REPEAT
MASKS = 1 << len(FILTERS)

MIN_WORDS = 50
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"
#: Bytes of UTF-8 that do not begin a code point.
CONTINUATION = bytes(range(0x80, 0xC0))

#: Cells of a counting block, and the 64-bit words that hold one bit of each.
BLOCK_CELLS = 4096
BLOCK_WORDS = BLOCK_CELLS // 64
#: Cells per text, and cells that a text counts in.
CELLS_PER_TEXT, PROBES = 16, 4
#: Where in a hash the bits of its cells begin; the block is chosen by the bits from the 32nd on.
SHIFTS = [0, 12, 20, 52]
#: Blocks are read by every task, so there are at most so many (128 MB of bits). With more texts than CELLS_PER_TEXT allows
#: for, more unique texts look like possible repeats and are shuffled as well; the result stays the same.
MAX_BLOCKS = 1 << 18
#: Hashes that a task gathers before it emits its counts.
GATHERED = 500_000


def own_mask(text: bytes) -> int:
    """Bits of the OWN_FILTERS that a text fails; the words of bytes.split() are those between ASCII white space."""
    words = text.split()
    n = len(words)
    points = len(text) if text.isascii() else len(text.translate(None, CONTINUATION))
    return (
        (n < MIN_WORDS)
        | (100 * len(set(words)) < 65 * n) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > 5 * points) << 2
        | (len(text.translate(None, SIGNS)) < len(text)) << 3
    )


def blocks_for(texts: int) -> int:
    return min(MAX_BLOCKS, max(1, -(-texts * CELLS_PER_TEXT // BLOCK_CELLS)))


def block_of(hashed: Column, blocks: int) -> Column:
    """The block of a 64-bit hash."""
    return F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(blocks)).cast("int")


def cell_of(hashed: Column, probe: int) -> Column:
    """One of the PROBES cells of a hash in its block."""
    return F.shiftrightunsigned(hashed, SHIFTS[probe]).bitwiseAND(F.lit(BLOCK_CELLS - 1)).cast("int")


def task_counts(hashes: DataFrame, blocks: int) -> DataFrame:
    """(block, cells) counting sketches of parts of the rows: the cells of a block in order, with the top bit set where
    the part counts two or more."""
    def emit(block: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
        flat = np.sort((block.astype(np.int64)[:, None] * BLOCK_CELLS + cells).ravel())
        first = np.concatenate([[True], flat[1:] != flat[:-1]])
        at = np.flatnonzero(first)
        twice = np.diff(np.append(at, len(flat))) > 1
        code = (flat[at] % BLOCK_CELLS).astype("<u2") | (twice.astype("<u2") << 15)
        of = flat[at] // BLOCK_CELLS
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        raw = code.astype("<u2").tobytes()
        ends = np.append(cuts[1:], len(of)) * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(of[cuts].astype(np.int32)),
             pa.array([raw[s:e] for s, e in zip((cuts * 2).tolist(), ends.tolist())], pa.binary())],
            ["block", "cells"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy() for k in range(1 + PROBES)], axis=1))
            n += batch.num_rows
            if n >= GATHERED:
                rows = np.concatenate(held)
                yield emit(rows[:, 0], rows[:, 1:])
                held, n = [], 0
        if n:
            rows = np.concatenate(held)
            yield emit(rows[:, 0], rows[:, 1:])

    placed = hashes.select(
        block_of(F.col("h"), blocks).alias("block"), *[cell_of(F.col("h"), p).alias(f"c{p}") for p in range(PROBES)]
    )
    return placed.mapInArrow(run, "block int, cells binary")


def merged_sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """(block, repeated): for each block the bits of the cells that count two or more over all rows.

    Counts stop at two, so merging is the union of the cells counted twice in a part or met in two parts.
    """
    def work(table: pa.Table) -> list[pa.RecordBatch]:
        block, cells = table.column("block").to_numpy(), table.column("cells").to_pylist()
        starts, out, rows = starts_of(table, 1), [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
            code = np.frombuffer(b"".join(cells[s:e]), dtype="<u2")
            counts = np.bincount(code & 0x7FFF, minlength=BLOCK_CELLS) + np.bincount(
                code[code >> 15 > 0] & 0x7FFF, minlength=BLOCK_CELLS
            )
            bits = np.packbits(counts > 1, bitorder="little")
            if bits.any():
                out.append(int(block[s]))
                rows.append(bits.view("<i8").tolist())
        return [pa.RecordBatch.from_arrays(
            [pa.array(out, pa.int32()), pa.array(rows, pa.list_(pa.int64()))], ["block", "repeated"]
        )]

    dealt = task_counts(hashes, blocks).repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(lambda batches: by_group(batches, 1, work), "block int, repeated array<bigint>")


def possible_repeat(hashed: Column, repeated: Column) -> Column:
    """Whether all cells of a hash count two or more; no bits for its block: no."""
    found = F.lit(True)
    for probe in range(PROBES):
        cell = cell_of(hashed, probe)
        found = found & (F.getbit(F.get(repeated, F.shiftright(cell, 6)), cell.bitwiseAND(F.lit(63))) == 1)
    return F.coalesce(found, F.lit(False))


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask, h and text of every document: the mask of the OWN_FILTERS, and the text only where a copy of it
    may exist."""
    base = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_of("text").alias("text"),
    )
    hashes = materialize(base.select(F.xxhash64("text").alias("h")), "hashes")
    blocks = blocks_for(hashes.count())
    sketch = materialize(merged_sketch(hashes, blocks), "sketch")
    hashed = base.withColumn("h", F.xxhash64("text")).withColumn("block", block_of(F.col("h"), blocks))
    probed = hashed.join(F.broadcast(sketch), "block", "left").select(
        "doc_id", "part", "h", possible_repeat(F.col("h"), F.col("repeated")).alias("maybe"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe, texts = batch.column(3), batch.column(4)
            mask = pa.array(map(own_mask, texts.cast(pa.binary()).to_pylist()), pa.int32())
            kept = pc.if_else(maybe, texts, pa.scalar(None, texts.type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), mask, batch.column(2), kept], ["doc_id", "part", "mask", "h", "text"]
            )

    return probed.mapInArrow(run, "doc_id bigint, part string, mask int, h bigint, text string")


def flags(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every row of ``docs`` (doc_id, text, source): bit k of the mask is set if the document
    fails filter k of FILTERS.

    Only possible repeats shuffle with their texts; these are reduced to the smallest id of each full text before and
    after the shuffle, so a text that a third of all rows share costs one row per task.
    """
    rows = materialize(marked(docs), "flags")
    repeats = rows.filter("text IS NOT NULL AND doc_id IS NOT NULL")
    # A row is the first of its text if its id is the least one of the text; its hash tells texts of one id apart.
    firsts = repeats.groupBy("h", "text").agg(F.min("doc_id").alias("doc_id")).select(
        "doc_id", "h", F.lit(True).alias("first")
    ).distinct()
    later = repeats.select("doc_id", "part", "mask", "h").join(firsts, ["doc_id", "h"], "left").select(
        "doc_id", "part",
        F.when(F.col("first").isNull(), F.col("mask").bitwiseOR(1 << FILTERS.index(REPEAT))).otherwise(F.col("mask"))
        .alias("mask"),
    )
    single = rows.filter("text IS NULL OR doc_id IS NULL").select("doc_id", "part", "mask")
    return single.unionByName(later)


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and mask, and how many of them are labelled good or toxic.

    A document is good or toxic if any of its label rows says so; labels without id count for none.
    """
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    none = F.lit(None).cast("int")
    met = flagged.filter("doc_id IS NOT NULL").join(known, "doc_id", "left").unionByName(
        flagged.filter("doc_id IS NULL").withColumns({"good": none, "toxic": none})
    )
    return met.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def outcomes() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """All (order, step), and for each measure the weight of every mask in it (rows: order and step)."""
    masks = np.arange(MASKS)
    failed = np.array([int(m).bit_count() for m in masks])
    steps, rows = [], {c: [] for c in ("kept", "removed", "redundant", "unique_fails", "shapley")}
    n_orders = len(list(itertools.permutations(FILTERS)))
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            fails, gone = masks & bit > 0, masks & before > 0
            steps.append(("".join(order), step))
            rows["removed"].append(fails & ~gone)
            rows["redundant"].append(fails & gone)
            rows["kept"].append(~fails & ~gone)
            rows["unique_fails"].append(masks == bit)
            # Each failed filter comes first among the failed ones in an equal share of all orders.
            rows["shapley"].append(np.where(fails, n_orders // np.maximum(failed, 1), 0))
            before |= bit
    return steps, {c: np.array(r, dtype=np.int64) for c, r in rows.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def report(counts: DataFrame) -> DataFrame:
    """One row per part, filter_order and step from ``mask_counts``, of which a part has one row per mask."""
    def held(column: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask") == m, F.col(column)).otherwise(0)) for m in range(MASKS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, weight = outcomes()
        orders, numbers = [o for o, _ in steps], np.array([s for _, s in steps], dtype=np.int32)
        for batch in batches:
            for part, n, good, toxic in zip(*(batch.column(k).to_pylist() for k in range(4))):
                n, good, toxic = (np.array(v, dtype=np.int64) for v in (n, good, toxic))
                made = {c: w @ n for c, w in weight.items()}
                made |= {"good_lost": weight["removed"] @ good, "toxic_lost": weight["removed"] @ toxic}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(steps)), pa.array(orders), pa.array(numbers), *(pa.array(made[c]) for c in COLUMNS)],
                    ["part", "filter_order", "step", *COLUMNS],
                )

    per_part = counts.groupBy("part").agg(*[held(c).alias(c) for c in ("n", "good", "toxic")])
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COLUMNS)
    return per_part.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Kept, removed, redundant, unique, lost and Shapley counts of the FILTERS in all orders, per source of ``docs``.

    A counting Bloom filter of the texts' hashes, made per task and merged, clears texts that occur once; only the others
    are shuffled and compared in full. The filters' flags make a mask per document, and everything is a sum over counts
    per part and mask, which are additive.

    Null texts are empty texts, null sources the empty string. A document without id has no smaller one and is none for
    others; of rows with the same id and text none is the earlier one. An empty table gives no rows; other columns, also
    of clashing names, are ignored.
    """
    return report(materialize(mask_counts(flags(docs), labels), "masks"))
