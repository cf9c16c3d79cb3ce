import numpy as np
import pytest
import tiktoken  # noqa: F401

import corpus_pipeline
from riskloom.llm import minhash, quality, secrets, toxicity
from riskloom.llm.packing import VOCABULARY
from riskloom.llm.vocab import encoding_of, vocabulary
from riskloom.sources.tables import table


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf), name)
        out.append(docs)
    return [table(spark, sf, "documents"), *out]


def ids(frame, where="true"):
    return {r[0] for r in frame.filter(where).select("doc_id").collect()}


def test_each_stage_takes_effect(spark, sf, stages):
    docs, good, clean, single, hidden, packed = stages
    labels = table(spark, sf, "labels")
    assert ids(good) == ids(quality.assess(docs, labels), "kept") < ids(docs)
    assert ids(clean) == ids(toxicity.detect(good, labels), "NOT is_toxic") < ids(good)
    assert ids(single) == ids(minhash.deduplicate(clean), "kept") < ids(clean)
    assert ids(hidden) == ids(single)
    found = ids(secrets.scan(single), "is_secret")
    before = {r.doc_id: r.text for r in single.collect()}
    changed = {r.doc_id for r in hidden.collect() if r.text != before[r.doc_id]}
    assert changed == found
    for frame in (good, clean, single, hidden):
        assert frame.columns == docs.columns


def test_packed_ids_are_the_texts(stages):
    hidden, packed = stages[4], stages[5]
    encode = encoding_of(vocabulary(VOCABULARY)).encode_ordinary
    got = {}
    for p in sorted(packed.collect(), key=lambda p: p.start):
        got.setdefault(p.doc_id, []).append(bytes(p.ids))
    for r in hidden.collect():
        assert b"".join(got.pop(r.doc_id)) == np.array([*encode(r.text), 1], "<u4").tobytes()
    assert not got


def test_run_gives_the_same_rows(spark, sf, stages):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == stages[-1].columns
    key = ["doc_id", "doc_tokens", "ids"]
    assert rows.groupBy("doc_id").agg({"length": "sum"}).exceptAll(stages[-1].groupBy("doc_id").agg({"length": "sum"})).count() == 0
    assert set(key) <= set(rows.columns)
