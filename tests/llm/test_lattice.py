import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import lattice
from riskloom.llm.vocab import vocabulary

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def model():
    return lattice.read_pieces(vocabulary(lattice.VOCABULARY))


def ways(model, word):
    """All segmentations and their probabilities."""
    logs, raw = dict(zip(model.pieces, model.logs)), b" " + word.encode()

    def go(i):
        if i == len(raw):
            return [((), math.exp(model.stop))]
        return [
            ((raw[i:j], *rest), math.exp(logs[raw[i:j]] + (model.go if i else 0.0)) * p)
            for j in range(i + 1, len(raw) + 1) if raw[i:j] in logs for rest, p in go(j)
        ]

    return go(0)


@pytest.mark.parametrize("word", ["a", "the", "thntwh", "éoi", "---x", "\x01", "words,", "日本"])
def test_forward_sums_all_segmentations(model, word):
    total = sum(p for _, p in ways(model, word))
    assert lattice.Lattice(model).log10([word])[0] == pytest.approx(math.log10(total), abs=1e-9)


def test_expected_uses(model):
    words = ["the", "thing", "the", "éo"]
    wanted = Counter()
    for w in words:
        all_ways = ways(model, w)
        total = sum(p for _, p in all_ways)
        for pieces, p in all_ways:
            for piece in pieces:
                wanted[piece] += p / total
    got = lattice.Lattice(model).expected(words)
    assert {model.pieces[k]: pytest.approx(got[k]) for k in np.flatnonzero(got > 1e-12)} == {
        k: v for k, v in wanted.items() if v > 1e-12
    }


def test_long_word(model):
    assert np.isfinite(lattice.Lattice(model).log10(["x" * 5000])[0])


def corpus():
    rng = random.Random(4)
    names = ["".join(rng.choice(["th", "er", "ing", "a", "on"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(names) for _ in range(40))) for k in range(80)]
    return rows + [(100, None), (101, ""), (102, "NEVER seen Before"), (105, "y" * 3000), (None, "no id"), (5, rows[5][1])]


def test_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, token string")
    got = lattice.score(docs).collect()
    assert len(got) == len(rows)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = [(i, WORD.findall((t or "").translate(LOW)) + ["\n"]) for i, t in rows]
    seen = Counter(w for i, own in tokens if not held[i] for w in own)
    n, v = sum(seen.values()), len(seen)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, own in tokens:
        for r in by_id[i]:
            base = sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own)
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(own), n)
            assert r.n_known == sum(seen[w] > 0 for w in own)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert math.isfinite(r.score) and r.score < 0
    assert len(by_id[5]) == 2 and by_id[5][0].score == by_id[5][1].score
    assert by_id[105][0].score < -500


def test_model_is_normalised_and_prefers_its_language(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    counts = lattice.word_counts(docs)
    model = lattice.fit_pieces(counts, vocabulary(lattice.VOCABULARY))
    first = np.array([p[:1] == b" " for p in model.pieces])
    assert np.exp(model.logs[first]).sum() == pytest.approx(1) and np.exp(model.logs[~first]).sum() == pytest.approx(1)
    assert math.exp(model.stop) + math.exp(model.go) == pytest.approx(1)
    own, other = lattice.Lattice(model).log10(["therthing", "qzxwvkjqz"])
    assert own > other + 3


def test_empty_table(spark):
    assert lattice.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
