"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import across, block_pairs, by_group, components, local_components, starts_of
from riskloom.llm.shingles import mix, shingle_sets, word_hashes
from riskloom.llm.vocab import parts
from riskloom.session import materialize

SHINGLE = 5
SIMILARITY = 75  # per cent
#: Two collections of so many small keys, each of PART minhashes; every pair of one key from each is a table, so
#: 2 * COLLECTION * PART minhashes make COLLECTION ** 2 tables of 2 * PART. At a similarity of 0.75 a pair shares no
#: table with a probability of 2 * (1 - 0.75 ** 2) ** 10 = 0.0005, at 0.85 of 0.000005.
COLLECTION = 10
PART = 2
#: Of the 40 minhashes so many must agree before sets are compared; at 0.75 fewer do with a probability of 0.000003.
AGREE = 18
BLOCK = 512

SEEDS = mix(np.arange(1, 2 * COLLECTION * PART + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
MULTIPLIERS = mix(SEEDS + np.uint64(7)) | np.uint64(1)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set of 2 * COLLECTION * PART minhashes (32 bits); rows of empty sets are 0."""
    out = np.zeros((len(sets), len(SEEDS)), dtype=np.uint32)
    full = [k for k, s in enumerate(sets) if len(s)]
    if not full:
        return out
    cells = np.concatenate([sets[k] for k in full])
    sizes = np.array([len(sets[k]) for k in full])
    begin = np.cumsum(sizes) - sizes
    for i in range(len(SEEDS)):
        out[full, i] = np.minimum.reduceat(((cells ^ SEEDS[i]) * MULTIPLIERS[i]) >> np.uint64(32), begin)
    return out


def table_keys(hashes: np.ndarray) -> np.ndarray:
    """COLLECTION ** 2 keys per row: each small key of the first collection with each of the second."""
    small = hashes.astype(np.uint64).reshape(len(hashes), 2, COLLECTION, PART)
    keys = np.zeros(small.shape[:3], dtype=np.uint64)
    for p in range(PART):
        keys = mix(keys + small[..., p] + np.uint64(p + 1))
    first, second = keys[:, 0, :, None], keys[:, 1, None, :]
    table = np.arange(COLLECTION**2, dtype=np.uint64).reshape(1, COLLECTION, COLLECTION)
    return mix(mix(first + table) ^ second).reshape(len(hashes), -1)


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of batches (whose last column is the text) with the shingle sets of their texts."""
    for batch in batches:
        start = 0
        for part in parts([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]):
            yield batch.slice(start, len(part)), shingle_sets(*word_hashes(part), SHINGLE)
            start += len(part)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set and the minhashes of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in text_batches(batches):
            hashes = minhashes(sets)
            sums = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
            folds = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(1)), initial=0) for s in sets], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums.view(np.int64)),
                pa.array(folds.view(np.int64)), pa.array([h.tobytes() for h in hashes], pa.binary()),
            ], ["doc_id", "n_shingles", "fp1", "fp2", "hashes"])

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, hashes binary")


def keys_of(signed: DataFrame, tables: slice = slice(None)) -> DataFrame:
    """(key, doc_id), a row per document and table: COLLECTION ** 2 of them, or the chosen ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                hashes = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint32)
                keys = np.ascontiguousarray(table_keys(hashes.reshape(part.num_rows, -1))[:, tables])
                ids = np.repeat(part.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], ["key", "doc_id"])

    return signed.select("doc_id", "hashes").mapInArrow(run, "key bigint, doc_id bigint")


def agreeing(hashes: np.ndarray) -> np.ndarray:
    """Which pairs of rows agree in AGREE places at least."""
    same = np.zeros((len(hashes), len(hashes)), dtype=np.uint8)
    for i in range(hashes.shape[1]):
        same += hashes[:, None, i] == hashes[None, :, i]
    return same >= AGREE


def edge_batches(ids: list[np.ndarray], tops: list[np.ndarray]) -> list[pa.RecordBatch]:
    if not ids:
        return []
    pairs = np.unique(np.stack([np.concatenate(ids), np.concatenate(tops)]), axis=1)
    return [pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])]


def bucket_edges(buckets: DataFrame) -> DataFrame:
    """In each bucket (key, bi, bj): documents whose minhashes agree, as edges between the groups that they are in so
    far; never all pairs, and none inside a group."""
    def work(table: pa.Table) -> list[pa.RecordBatch]:
        ids, own = table.column("doc_id").to_numpy(), table.column("own").to_numpy()
        bi, bj = table.column("bi").to_numpy(), table.column("bj").to_numpy()
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.uint32)
        hashes, group = hashes.reshape(len(ids), -1).astype(np.uint16), table.column("grp").to_numpy()
        starts = starts_of(table, 3)
        found, tops = [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            if (group[s:e] == group[s]).all():
                continue
            if e - s == 2 and bi[s] == bj[s]:
                if (hashes[s] == hashes[s + 1]).sum() >= AGREE:
                    found.append(group[s : s + 1])
                    tops.append(group[s + 1 : s + 2])
            else:
                label = local_components(across(agreeing(hashes[s:e]), own[s:e], bi[s], bj[s]))
                moved = np.flatnonzero(group[s:e] != group[s:e][label])
                found.append(group[s:e][moved])
                tops.append(group[s:e][label[moved]])
        return edge_batches(found, tops)

    chosen = buckets.select("key", "bi", "bj", "own", "doc_id", "grp", "hashes")
    dealt = chosen.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return dealt.mapInArrow(lambda batches: by_group(batches, 3, work), "a bigint, b bigint").distinct()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified_edges(rows: DataFrame, percent: int) -> DataFrame:
    """Links of each group (grp, bi, bj) of documents with their sets, confirmed on the sets, as a spanning forest:
    pairs that are connected already are not compared again."""
    def work(table: pa.Table) -> list[pa.RecordBatch]:
        ids, own = table.column("doc_id").to_numpy(), table.column("own").to_numpy()
        bi, bj = table.column("bi").to_numpy(), table.column("bj").to_numpy()
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.uint32)
        hashes = hashes.reshape(len(ids), -1).astype(np.uint16)
        sets = [np.frombuffer(v, dtype=np.uint64) for v in table.column("shingles").to_pylist()]
        starts = starts_of(table, 3)
        found, tops = [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            maybe = across(agreeing(hashes[s:e]), own[s:e], bi[s], bj[s])
            label = np.arange(e - s)
            for x, y in np.argwhere(np.triu(maybe, 1)).tolist():
                if label[x] != label[y] and similar(sets[s + x], sets[s + y], percent):
                    label[label == max(label[x], label[y])] = min(label[x], label[y])
            moved = np.flatnonzero(label != np.arange(e - s))
            found.append(ids[s:e][moved])
            tops.append(ids[s:e][label[moved]])
        return edge_batches(found, tops)

    chosen = rows.select("grp", "bi", "bj", "own", "doc_id", "hashes", "shingles")
    dealt = chosen.repartition("grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj")
    return dealt.mapInArrow(lambda batches: by_group(batches, 3, work), "a bigint, b bigint").distinct()


def sets_of(docs: DataFrame) -> DataFrame:
    """The frame (its last column the text) with the sorted shingle hashes instead of the text."""
    names = docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in text_batches(batches):
            raw = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], raw], [*names, "shingles"])

    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes[:-1])
    return docs.mapInArrow(run, f"{schema}, shingles binary")


def deduplicate(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    1. One pass over the texts gives each row's set size, fingerprint and minhashes. Rows with equal sets form a class;
       only its smallest doc_id goes on, so exact copies cost one row each.
    2. Every pair of one small key from each of two collections of minhashes is a table key. Keys held by one document
       are dropped; in the buckets of the others documents whose minhashes agree are tied to one of them: first in the
       tables that share no small key, then in all, where only ties between different groups are left. Large buckets
       are cut into pairs of blocks.
    3. The components of these ties are the groups in which links are confirmed on full sets, again in blocks.
    4. The components of the confirmed links are the result.

    Similarity is that of sets of distinct shingles of five words (lower-cased A to Z), at least ``percent`` per cent.
    Shorter texts are one shingle; null, empty and blank texts have none and are linked with nothing. Shingles meet by
    64-bit hashes. Null doc_ids are linked with nothing and kept; rows of one doc_id count as one document. An empty
    table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(signatures(texts), "signatures")
    print_of = ["n_shingles", "fp1", "fp2"]
    linkable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy(*print_of).agg(
        F.min("doc_id").alias("class_id"), F.min_by("hashes", "doc_id").alias("hashes")
    )
    classes = materialize(classes, "classes")
    heads = classes.select(F.col("class_id").alias("doc_id"), "hashes")
    grouped = None
    for tables in (slice(0, None, COLLECTION + 1), slice(None)):  # first those that share no small key, then all
        keys = keys_of(heads, tables)
        shared = keys.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1")
        known = heads.withColumn("grp", F.col("doc_id"))
        if grouped is not None:
            known = heads.join(grouped, "doc_id", "left").withColumn("grp", F.coalesce("grp", "doc_id"))
        placed = keys.join(shared, "key").join(known, "doc_id")
        ties = bucket_edges(block_pairs(placed, ["key"], "held", "doc_id", BLOCK))
        if grouped is not None:
            ties = ties.unionByName(grouped.select(F.col("doc_id").alias("a"), F.col("grp").alias("b")))
        grouped = components(ties).select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    sizes = grouped.groupBy("grp").agg(F.count("*").alias("size"))
    members = grouped.join(sizes, "grp").join(heads, "doc_id").select("doc_id", "grp", "size", "hashes")
    with_text = members.join(texts.filter("doc_id IS NOT NULL"), "doc_id")
    rows = sets_of(with_text.select("doc_id", "grp", "size", "hashes", "text"))
    links = verified_edges(block_pairs(rows, ["grp"], "size", "doc_id", BLOCK), percent)
    joined = components(links).withColumnRenamed("node", "class_id")
    found = classes.select(*print_of, "class_id").join(joined, "class_id", "left").select(
        *print_of, F.coalesce("component", "class_id").alias("component")
    )
    return signed.select("doc_id", *print_of).join(found, print_of, "left").select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
        .otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
