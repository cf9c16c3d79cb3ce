"""Sum-of-squares online packing of tokenised documents into windows of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.vocab import parts, encoding_of, vocabulary

WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.tiktoken"  # the ranks of byte_bpe_50k.json
#: Open windows that one task keeps; beyond that they are closed early, so memory stays bounded.
OPEN_WINDOWS = 2048

SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
FIELDS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


class SumOfSquares:
    """Windows that are being filled, and the number of them at each fill level.

    A piece goes where the sum of the squared counts of partly filled windows becomes least; empty and full windows do
    not count. Ties go to the fullest window. Pieces are (doc_id, start, ids as bytes, doc_tokens).
    """

    def __init__(self, window: int, first_id: int, open_windows: int = OPEN_WINDOWS):
        self.window, self.next_id, self.limit = window, first_id, open_windows
        self.count = np.zeros(window + 1, dtype=np.int64)  # at 0 and window: always 0
        self.at: dict[int, list[list]] = {}  # level -> the pieces of each window there
        self.n_open = 0
        self.done: list[tuple] = []

    def level_for(self, size: int) -> int:
        """The fill level of the window that takes the piece; 0 opens a new one."""
        levels = np.flatnonzero(self.count[: self.window - size + 1])
        if not len(levels):
            return 0
        grows = np.where(levels + size < self.window, 2 * self.count[levels + size] + 1, 0)
        change = grows - 2 * self.count[levels] + 1
        best = len(levels) - 1 - int(np.argmin(change[::-1]))
        return int(levels[best]) if change[best] <= 2 * self.count[size] + 1 else 0

    def add(self, doc_id: int, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            self.close([(doc_id, start, ids[4 * start : 4 * (start + self.window)], total)])
        if total > whole:
            self.place((doc_id, whole, ids[4 * whole :], total), total - whole)

    def place(self, piece: tuple, size: int) -> None:
        level = self.level_for(size)
        pieces: list = []
        if level:
            pieces = self.at[level].pop()
            self.count[level] -= 1
        else:
            self.n_open += 1
        pieces.append(piece)
        if level + size == self.window:
            self.n_open -= 1
            self.close(pieces)
            return
        self.at.setdefault(level + size, []).append(pieces)
        self.count[level + size] += 1
        if self.n_open > self.limit:
            self.finish()

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.done.append((doc_id, start, len(ids) // 4, ids, total, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def finish(self) -> None:
        """Close all windows: the emptiest fill up the fullest, the last piece being cut where it must; one at most
        stays partly filled."""
        left = [pieces for level in sorted(self.at) for pieces in self.at[level]]  # emptiest first
        self.at, self.n_open = {}, 0
        self.count[:] = 0
        spare: list = []
        while left:
            pieces = left.pop()
            room = self.window - sum(len(p[2]) // 4 for p in pieces)
            while room and (spare or left):
                if not spare:
                    spare = left.pop(0)
                doc_id, start, ids, total = spare.pop()
                n = min(room, len(ids) // 4)
                pieces.append((doc_id, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    spare.append((doc_id, start + n, ids[4 * n :], total))
                room -= n
            self.close(pieces)
        if spare:
            self.close(spare)

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(
    docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """One row per piece of a document: its ids (little-endian unsigned 32-bit) and its place in a sequence.

    Each task packs the rows of its own split in their order, without a shuffle; sequence ids carry the partition's
    number in their upper bits. Documents longer than a window fill whole windows first. When a task ends, its open
    windows fill each other up, so at most one sequence per task is short.

    A null or empty text has only the end id. Null and repeated doc_ids are kept as they are. An empty table gives no
    rows. Columns other than doc_id and text are ignored. Equal choices go to the fullest window.
    """
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding_of(path).encode_ordinary
        state = SumOfSquares(window, TaskContext.get().partitionId() << 40, open_windows)

        def rows() -> pa.RecordBatch:
            done = state.take()
            columns = zip(*done) if done else [[] for _ in FIELDS]
            kinds = [pa.binary() if f == "ids" else pa.int64() for f in FIELDS]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FIELDS)

        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for part in parts([t or "" for t in batch.column(1).to_pylist()]):
                for text, doc_id in zip(part, doc_ids):
                    state.add(doc_id, np.array([*encode(text), end_id], dtype="<u4").tobytes())
                yield rows()
        state.finish()
        yield rows()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
