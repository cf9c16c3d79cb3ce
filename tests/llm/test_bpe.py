import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import bpe
from riskloom.llm.vocab import ranks_of, vocabulary

PATH = vocabulary(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(PATH), special_tokens={})


def raw(library, text):
    return np.array(library.encode_ordinary(text), dtype="<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_texts(texts):
    library = tiktoken.Encoding(
        "h", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(PATH), special_tokens={}
    )
    assert bpe.encoder_of(PATH)(texts) == [raw(library, t) for t in texts]


@pytest.mark.parametrize("text", [
    "", " ", "  ", "\n", " a", "a ", "a  b", "a \nb", "a\n b", "x\tb c", "it's we'll", "ab" * 4000, "a" * 5000, "é" * 3000,
    "word " * 5000, "\x1c a\x85 b\u3000c",
])
def test_odd_texts(library, text):
    ids = bpe.encoder_of(PATH)([text])[0]
    assert ids == raw(library, text)
    assert bpe.decode_ids(np.frombuffer(ids, dtype="<u4"), PATH) == text.encode()


def test_operator(spark, library):
    rows = [(1, "Some words, some more words.", "c"), (2, None, "c"), (3, "", "c"), (None, "no id", "c"), (5, "twice", "c"),
            (5, "twice", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs)).collect()
    key = lambda r: (repr(r[0]), r[1])
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=key) == sorted(
        ((i, raw(library, t or ""), (t or "").encode()) for i, t, _ in rows), key=key
    )
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_query(spark, sf, library):
    import __spark_entry__ as entry

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in entry.queries()["op7_byte_bpe"](spark, sf).collect():
        ids = raw(library, texts[row.doc_id])
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
