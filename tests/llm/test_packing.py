import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskloom.llm import packing
from riskloom.llm.vocab import vocabulary

DOCS = [
    (1, "A short text."), (2, None), (3, ""), (4, "many words " * 3000), (5, "  odd\t\n white  space \u3000 é 😀 "),
    (5, "  odd\t\n white  space \u3000 é 😀 "), (None, "no id"), (7, "x" * 20000), (8, "<|endoftext|> is text"),
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_pieces_hold_every_id_once(spark, tokenizer):
    rows = [(i, t, "src", "clash", 1) for i, t in DOCS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, ids string, offset int").repartition(3)
    pieces = packing.pack(docs).collect()
    wanted = sorted(
        (repr(i), np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in DOCS
    )
    by_doc = {}
    for p in sorted(pieces, key=lambda p: (repr(p.doc_id), p.start)):
        by_doc.setdefault(p.doc_id, []).append(p)
        assert p.length == len(p.ids) // 4
    for doc_id, own in by_doc.items():
        texts = [raw for i, raw in wanted if i == repr(doc_id)]
        assert sum(p.length for p in own) == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            assert b"".join(bytes(p.ids) for p in own) == texts[0]
            assert own[0].doc_tokens == len(texts[0]) // 4
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= packing.WINDOW
    assert sum(sum(p.length for p in own) < packing.WINDOW for own in sequences.values()) <= 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0


def test_level_minimises_sum_of_squares():
    rng = np.random.default_rng(1)
    state = packing.SumOfSquares(64, 0)
    for k in range(300):
        size = int(rng.integers(1, 64))
        best = {}
        for level in [0, *np.flatnonzero(state.count[: 64 - size + 1]).tolist()]:
            after = state.count.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 64
            best[level] = int((after[:64] ** 2).sum())
        level = state.level_for(size)
        assert best[level] == min(best.values())
        state.add(k, b"\0\0\0\0" * size)
    state.finish()
    filled = {}
    for _, _, length, _, _, sequence, _ in state.done:
        filled[sequence] = filled.get(sequence, 0) + length
    assert sum(v < 64 for v in filled.values()) <= 1


def test_open_windows_are_bounded():
    state = packing.SumOfSquares(64, 0, open_windows=10)
    for k in range(100):
        state.add(k, b"\1\0\0\0" * 33)  # no two fit together
        assert state.n_open <= 11
    state.finish()
    assert sum(n for _, _, n, *_ in state.done) == 3300


def test_query_checksums(spark, sf, tokenizer):
    import __spark_entry__ as entry

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in entry.queries()["op1_sum_of_squares_packing"](spark, sf).collect():
        if row.doc_id % 10 == 0:
            ids = [*tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids, 1]
            own = np.array(ids[row.start : row.start + row.length], "<u4").tobytes()
            assert (row.ids_crc32, row.doc_tokens) == (zlib.crc32(own), len(ids))
