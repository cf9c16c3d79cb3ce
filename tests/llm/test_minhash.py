import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import minhash
from riskloom.llm.shingles import shingle_sets, word_hashes

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    sets = {i: plain_set(t) for i, t in rows if i is not None}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus():
    rng = random.Random(2)
    names = [f"w{k}" for k in range(400)]
    rows = [(None, "null id text of some words"), (1, None), (2, ""), (3, " \n"), (4, "Two words"), (5, "two WORDS"), (6, "two"),
            (7, "É a b c d e"), (8, "é a b c d e")]
    n = 10
    for _ in range(12):
        base = [rng.choice(names) for _ in range(120)]
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(names)
            rows.append((n, " ".join(words)))
            n += 1
    chain = [rng.choice(names) for _ in range(140)]
    for k in range(12):  # neighbours are similar, ends are not
        rows.append((n, " ".join(chain)))
        chain[k * 10] = f"new{k}"
        n += 1
    shared = [rng.choice(names) for _ in range(60)]
    for _ in range(60):  # a common passage is no link
        rows.append((n, " ".join(shared + [rng.choice(names) for _ in range(rng.randrange(30, 90))])))
        n += 1
    rows += [(n, "copy of one text with some words"), (n + 1, "copy of one text with some words")] + [(n, "copy of one text with some words")]
    return rows


@pytest.mark.parametrize("block", [4, minhash.BLOCK])
def test_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_shingles int, grp string")
    got = minhash.deduplicate(docs).collect()
    assert len(got) == len(rows)
    wanted = plain(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == wanted[r.doc_id]
        else:
            assert r.component_id is None and r.kept


def test_empty_table(spark):
    assert minhash.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\téE\x0b　", max_size=40), max_size=6))
def test_shingle_hashes_follow_words(texts):
    words, counts = word_hashes(texts)
    split = [WORD.findall(t.translate(LOW)) for t in texts]
    assert counts.tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    assert len(set(zip(words.tolist(), flat))) == len(set(flat)) == len(set(words.tolist()))
    sets = shingle_sets(words, counts)
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    for a, x in zip(sets, texts):
        for b, y in zip(sets, texts):
            assert len(np.intersect1d(a, b)) == len(plain_set(x) & plain_set(y))


def test_tables_meet_as_stated():
    rng = np.random.default_rng(0)
    met = 0
    for _ in range(300):
        common = rng.integers(0, 2**63, 300).astype(np.uint64)
        pair = [np.unique(np.r_[common, rng.integers(0, 2**63, 50).astype(np.uint64)]) for _ in range(2)]  # 300 of 400
        keys = minhash.table_keys(minhash.minhashes(pair))
        met += bool(set(keys[0].tolist()) & set(keys[1].tolist()))
    assert met >= 298
    assert keys.shape[1] == minhash.COLLECTION**2
