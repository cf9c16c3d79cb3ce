"""Byte-level BPE in padded numpy matrices, and decoding."""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.vocab import parts, ranks_of, vocabulary

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NEVER = np.int32(2**31 - 1)
#: Pieces of more bytes are merged one by one with a heap, as a matrix row costs the square of its length.
LONG_PIECE = 2048
#: White space other than blanks and line feeds.
OTHER_SPACE = re.compile(r"[^\S \n]")
#: Cells of one matrix.
CELLS = 4_000_000


class PairTable:
    """(left id, right id) -> id of the joined bytes, by open addressing with linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, ids = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(rank)
        wanted, values = np.array(keys, dtype=np.int64), np.array(ids, dtype=np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ids = np.full(1 << self.bits, NEVER, dtype=np.int32)
        slots, self.probes = self.slot(wanted), 0
        while len(wanted):
            self.probes += 1
            free = np.flatnonzero(self.keys[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]], self.ids[slots[put]] = wanted[put], values[put]
            rest = np.ones(len(wanted), dtype=bool)
            rest[put] = False
            wanted, values, slots = wanted[rest], values[rest], (slots[rest] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs, NEVER where there is none or where a side is padding (-1)."""
        out = np.full(left.shape, NEVER, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[at].astype(np.int64) << 32 | right[at].astype(np.int64)
        slots = self.slot(keys)
        for _ in range(self.probes):
            held = self.keys[slots]
            hit = held == keys
            out[at[hit]] = self.ids[slots[hit]]
            go = ~hit & (held >= 0)
            if not go.any():
                break
            at, keys, slots = at[go], keys[go], (slots[go] + 1) & self.mask
        return out

    def one(self, left: int, right: int) -> int:
        return int(self.find(np.array([left]), np.array([right]))[0])


class Merger:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.table = ranks, PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) > LONG_PIECE:
                out[k] = self.merge_long(piece)
            elif piece:
                buckets.setdefault((len(piece) - 1) | 3, []).append(k)  # widths 4, 8, 12, ...
        for top, rows in buckets.items():
            step = max(1, CELLS // (top + 1))
            for i in range(0, len(rows), step):
                self.merge_rows(pieces, rows[i : i + step], top + 1, out)
        return out

    def merge_rows(self, pieces: list[bytes], rows: list[int], width: int, out: list[bytes]) -> None:
        """All rows at once: each round joins every row's leftmost pair of least rank and drops finished rows."""
        sizes = np.array([len(pieces[k]) for k in rows])
        held = np.arange(width) < sizes[:, None]
        ids = np.full((len(rows), width), -1, dtype=np.int32)
        ids[held] = self.byte_ids[np.frombuffer(b"".join(pieces[k] for k in rows), dtype=np.uint8)]
        joined = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        own = np.array(rows)
        while len(own):
            at = np.argmin(joined, axis=1) if joined.shape[1] else np.zeros(len(own), dtype=np.int64)
            line = np.arange(len(own))
            best = joined[line, at] if joined.shape[1] else np.full(len(own), NEVER)
            over = best == NEVER
            if over.any():
                flat = ids[over]
                counts = (flat >= 0).sum(axis=1) * 4
                raw, end = flat[flat >= 0].astype("<u4").tobytes(), 0
                for k, n in zip(own[over].tolist(), counts.tolist()):
                    out[k] = raw[end : end + n]
                    end += n
                go = ~over
                ids, joined, own, at, best = ids[go], joined[go], own[go], at[go], best[go]
                line = np.arange(len(own))
                if not len(own):
                    return
            ids[line, at] = best
            cells = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cells + (cells > at[:, None]), axis=1)
            cells = np.arange(joined.shape[1] - 1)
            joined = np.take_along_axis(joined, cells + (cells >= at[:, None]), axis=1)
            for shift in (-1, 0):
                left = at + shift
                ok = np.flatnonzero((left >= 0) & (left + 1 < ids.shape[1]))
                joined[ok, left[ok]] = self.table.find(ids[ok, left[ok]], ids[ok, left[ok] + 1])

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece, with a heap over linked pairs."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.table.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(r, k) for k, r in enumerate(first.tolist()) if r != NEVER]
        heapq.heapify(heap)
        rank = dict(enumerate(first.tolist()))
        while heap:
            r, k = heapq.heappop(heap)
            if rank.get(k, NEVER) != r:
                continue
            gone = after[k]
            ids[k], ids[gone], after[k] = r, -1, after[gone]
            rank.pop(gone, None)
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0:
                    right = after[left]
                    rank[left] = self.one(ids[left], ids[right]) if right < n else NEVER
                    if rank[left] != NEVER:
                        heapq.heappush(heap, (rank[left], left))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()

    def one(self, left: int, right: int) -> int:
        return self.table.one(left, right)


def lone_blanks(text: str) -> bool:
    """Every blank stands alone and no other white space but line feeds occurs.

    The vocabularies' pattern joins such a blank to what follows and never to what precedes, so the text may be cut
    before each of them.
    """
    return not ("  " in text or "\n " in text or " \n" in text or OTHER_SPACE.search(text))


class MatrixEncoder:
    """Ids of the texts of a batch, as little-endian unsigned 32-bit integers.

    Chunks end before lone blanks and pieces are cut by the public pattern; each distinct chunk is cut once, and the
    distinct pieces are merged together in matrices.
    """

    def __init__(self, path: str):
        self.merger = Merger(ranks_of(path))
        self.pattern = regex.compile(public_tokenizers.PATTERN)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        distinct = list(dict.fromkeys(pieces))
        ids = dict(zip(distinct, self.merger.encode([p.encode() for p in distinct])))
        return list(map(ids.__getitem__, pieces))

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of any texts."""
        split = [self.pattern.findall(t) for t in texts]
        ids = iter(self.pieces([p for s in split for p in s]))
        return [b"".join(itertools.islice(ids, len(s))) for s in split]

    def after_blank(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk with a blank before it; no chunk is empty or has a blank."""
        if not chunks:
            return []
        pieces = self.pattern.findall(" " + " ".join(chunks))
        starts = [k for k, piece in enumerate(pieces) if piece[0] == " "]
        ids = self.pieces(pieces)
        return [ids[a] if b - a == 1 else b"".join(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(pieces)])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        firsts, rests = [], []
        for text in texts:
            first, *rest = text.split(" ") if lone_blanks(text) else [text]
            firsts.append(first)
            rests.append(rest)
        chunks = set().union(*rests)
        chunks.discard("")
        known = dict(zip(chunks, self.after_blank(list(chunks))))
        known[""] = self.whole([" "])[0]
        begin = dict(zip(distinct := list(dict.fromkeys(firsts)), self.whole(distinct)))
        return [begin[first] + b"".join(map(known.__getitem__, rest)) for first, rest in zip(firsts, rests)]


@functools.cache
def encoder_of(path: str) -> MatrixEncoder:
    return MatrixEncoder(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every text, special tokens being ordinary text.

    No shuffle: each task encodes the rows of its split. A null or empty text has no ids (an empty value, not null).
    Null and repeated doc_ids are kept; an empty table gives no rows; other columns are ignored.
    """
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            start = 0
            for part in parts(texts):
                ids = pa.array(encoder(part), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), ids], ["doc_id", "ids"])
                start += len(part)

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id bigint, ids binary")


@functools.cache
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, and each id's start and length there."""
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.array([len(t) for t in tokens])
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    data, starts, sizes = byte_table(path)
    lengths = sizes[ids]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts[ids] - ends + lengths, lengths) + np.arange(total)].tobytes()


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """The frame with a column ``decoded``: the bytes that the column ``ids`` stands for; null ids give null."""
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 500
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                raw = [
                    None if v is None else decode_ids(np.frombuffer(v, dtype="<u4"), path)
                    for v in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"]
                )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, decoded binary")
