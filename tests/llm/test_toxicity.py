import random

import pytest

from riskloom.llm import toxicity


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    names = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(200)]
    rows, labels = [], []
    for k in range(240):
        toxic = k % 4 == 0
        words = [rng.choice(names) for _ in range(60)] + [rng.choice(["Idiot,", "scum", "moron!"]) for _ in range(3 * toxic)]
        low = k % 5 == 0
        rows.append((k, " ".join(w + "***" * low for w in rng.sample(words, len(words)))))
        if k < 160:
            labels.append((k, int(not low), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, corpus):
    rows, labels = corpus
    extra = [(900, None, 1.0), (901, "", 1.0), (None, "scum, idiot and moron. " * 9, 1.0), (902, "x" * 30000, 1.0)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows] + extra, "doc_id long, text string, p_toxic double")
    frame = spark.createDataFrame(labels + [(None, 1, 1), (3, None, 1), (999, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.detect(docs, frame).collect()}
    assert len(got) == len(rows) + len(extra)
    right = sum(got[k].is_toxic == (k % 4 == 0) for k in range(160, 240))
    assert right >= 77
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_low_quality <= 1 for r in got.values())
    assert got[None].is_toxic and not got[900].is_toxic and not got[902].is_toxic


def test_chain_feeds_earlier_probabilities(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = toxicity.fit_chain(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    sizes = [model.numFeatures for _, model in chain.models]
    assert [c for c, _ in chain.models] == ["low_quality", "toxic"]
    assert sizes == [len(chain.vocabulary.vocabulary), len(chain.vocabulary.vocabulary) + 1]


def test_without_labels_or_rows(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.is_toxic for r in toxicity.detect(docs, none).collect()] == [False] * 5
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.detect(docs.limit(0), frame).count() == 0
    one_kind = spark.createDataFrame([(k, 1, 0) for k in range(5)], "doc_id long, quality int, toxic int")
    assert not any(r.is_toxic for r in toxicity.detect(docs, one_kind).collect())


def test_repetition_of_one_word_tells(spark):
    texts = [(k, f"quiet {k % 7} words and more" + " clown" * (3 if k % 4 == 0 else k % 2)) for k in range(240)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(160)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.is_toxic for r in toxicity.detect(docs, labels).collect()}
    assert all(got[k] == (k % 4 == 0) for k in range(160, 240))
    terms = docs.filter("doc_id = 4").select(toxicity.terms(docs.text).alias("t")).first().t
    assert {"clown", "clown 2", "clown 3"} <= set(terms) and "quiet 2" not in terms and len(set(terms)) == len(terms)
