import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import occurrences
from riskloom.llm.vocab import vocabulary

PATH = vocabulary(occurrences.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_texts(texts):
    assert [ids_of(r) for r in occurrences.encoder_of(PATH)(texts)] == [library(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aab' \n\t1́e|<>ŻΣ", max_size=40), max_size=5))
def test_texts_of_few_characters(texts):
    assert [ids_of(r) for r in occurrences.encoder_of(PATH)(texts)] == [library(t) for t in texts]


@pytest.mark.parametrize("text", [
    "", " ", "\n", " a", "a  b", "x\tb　c", "it's we'll", "ab" * 40_000, "a" * 5000, "a" * 5001, "é" * 3000,
    "word " * 5000, "\x1c a\x85 b", "<|endoftext|>", "a<|startoftext|><|endoftext|> b", "<|end", "İ ẞ Å",
])
def test_odd_texts(text):
    assert ids_of(occurrences.encoder_of(PATH)([text])[0]) == library(text)


def test_chunks_with_other_white_space():
    """Runs of white space collapse; that must not shift pieces from one chunk to another."""
    texts = ["é\tb", "\t\t", "é\u3000\u2000c", "\xa0", "éc", "\t\té", "d\té\xa0", "ß \t\t é\n\t\n|1ẞs\tx"]
    for some in (texts, texts[::-1], texts * 3):
        got = occurrences.ChunkEncoder(PATH)([*some, " ".join(some)])
        assert [ids_of(r) for r in got] == [library(t) for t in [*some, " ".join(some)]]


def test_every_character():
    texts = [f"a{chr(c)}b {chr(c)}1" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    got = occurrences.encoder_of(PATH)(texts)
    assert [ids_of(r) for r in got] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_merged_as_one_by_one():
    """The index over all pieces against the plain rule: join the leftmost pair of least rank, piece by piece."""
    encoder = occurrences.ChunkEncoder(PATH)
    merges, vocabulary = encoder.merges, LIBRARY.get_vocab()

    def plain(piece):
        symbols = [vocabulary[c] for c in piece[:-1]] + [vocabulary[piece[-1] + "</w>"]]
        while len(symbols) > 1:
            ranks = merges.find(np.array(symbols[:-1]), np.array(symbols[1:]))
            at = int(ranks.argmin())
            if ranks[at] == occurrences.NEVER:
                break
            symbols[at : at + 2] = [int(merges.joined[ranks[at]])]
        return symbols

    rng = np.random.default_rng(3)
    pieces = list({"".join(rng.choice(list("aabeinrst"), size=rng.integers(1, 30))) for _ in range(500)} | {"aaaa", "aaaaa"})
    assert {p: ids_of(r) for p, r in encoder.merged(pieces).items()} == {p: plain(p) for p in pieces}


def test_forgotten_chunks_change_nothing(monkeypatch):
    encoder = occurrences.ChunkEncoder(PATH)
    monkeypatch.setattr(occurrences, "KNOWN_CHUNKS", 2)
    for text in ("one two three", "four five one", "two six"):
        assert ids_of(encoder([text])[0]) == library(text)
    assert len(encoder.known) < 6


def test_merges_in_the_wrong_order_are_refused():
    with pytest.raises(ValueError):
        occurrences.Merges({"vocab": {"a": 0, "b": 1, "c": 2, "ab": 3, "abc": 4}, "merges": [["ab", "c"], ["a", "b"]]})


def test_operator(spark):
    rows = [(1, "Some words, some more words.", "c"), (2, None, "c"), (3, "", "c"), (None, "no id", "c"),
            (5, "twice <|endoftext|>", "c"), (5, "twice <|endoftext|>", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = occurrences.decode(occurrences.encode(docs)).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=repr) == sorted(
        ((i, library(t or ""), LIBRARY.decode(library(t or ""), skip_special_tokens=False)) for i, t, _ in rows), key=repr
    )
    assert occurrences.decode(occurrences.encode(docs.limit(0))).count() == 0


def test_decode_of_unknown_and_null_ids(spark):
    coded = spark.createDataFrame([(1, [320, None, 999_999, 49407]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in occurrences.decode(coded).collect()}
    assert got == {1: LIBRARY.decode([320, 49407], skip_special_tokens=False), 2: None, 3: ""}


def test_query(spark, sf):
    import __spark_entry__ as entry

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entry.queries()["op12_pair_occurrence_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
