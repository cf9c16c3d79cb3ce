import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")
TOKEN = re.compile("[^\\W_]+|(?:[^\\w\x20\x09-\x0d]|_)+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \n\t", "one", "a b c", "a b c a b c", "x x x x x x", "a b c d a b c\n\n a b c d\nA b c d", "same\nsame\n same\nsame",
    "sym#*$%&|<> bols", "é ü 😀　ñ one word", "long " * 400, "end\r\nend\r\n", "a b a b a b c a b", "t\x0bu\x0cv\rw",
]


def test_counts(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = docs.select("doc_id", quality.base_counts(quality.text_of("text")).alias("c")).select("doc_id", "c.*").collect()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain_counts(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_random_counts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") + rng.choice(["", "\n", "*"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in docs.select("doc_id", quality.base_counts(F.col("text")).alias("c")).select("doc_id", "c.*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    names = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(150)]
    good = [" ".join(rng.choice(names) for _ in range(80)) for _ in range(40)]
    junk = [" ".join(rng.choice(names) + "***" for _ in range(80)) for _ in range(10)]
    return [(k, t) for k, t in enumerate(good + junk)]


def test_ratio_against_plain(spark, corpus):
    labels = [(k, 1, 0) for k in range(20)] + [(45, 0, 0), (None, 1, 0), (7, None, None)]
    docs = spark.createDataFrame([(k, t, True) for k, t in corpus] + [(None, None, None)], "doc_id long, text string, kept boolean")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.assess(docs, frame, buckets=512).collect()}

    def grams(text):
        tokens = TOKEN.findall(text)
        return [zlib.crc32(g.encode()) % 512 for g in tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]]

    whole, trusted = Counter(), Counter()
    for k, t in corpus:
        whole.update(grams(t))
        if k < 20:
            trusted.update(grams(t))
    n, m = sum(whole.values()) + 512, sum(trusted.values()) + 512
    for k, t in corpus:
        own = grams(t)
        ratio = sum(math.log((trusted[b] + 1) / m * n / (whole[b] + 1)) for b in own) / len(own)
        assert got[k].ratio == pytest.approx(ratio, abs=1e-9)
        assert got[k].kept == (ratio >= quality.THRESHOLD) == (k < 40)
    assert got[None].base_failed and not got[None].kept and got[None].ratio == 0
    assert list(quality.assess(docs, frame).columns[:3]) == ["doc_id", "text", "kept"]


def test_empty_frames(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.assess(docs, none).count() == len(corpus)
    assert quality.assess(docs.limit(0), none).count() == 0
