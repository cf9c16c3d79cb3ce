import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"word{k}" for k in range(60))


def fails_alone(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return "".join(
        name for name, bad in zip("ABCD", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)),
        )) if bad
    )


def plain(docs, labels):
    """Every order applied document by document."""
    fails = []
    for i, text, source in docs:
        earlier = [j for j, t, _ in docs if i is not None and j is not None and j < i and (t or "") == (text or "")]
        own = fails_alone(text or "") + ("E" if earlier else "")
        marks = [(q, t) for j, q, t in labels if j is not None and j == i]
        fails.append((source or "", own, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out = []
    for part in {p for p, *_ in fails}:
        held = [f[1:] for f in fails if f[0] == part]
        removed = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in itertools.permutations("ABCDE"):
            left = list(held)
            gone = []
            for step, name in enumerate(order, 1):
                here = [d for d in left if name in d[0]]
                redundant = sum(name in d[0] for d in gone)
                left = [d for d in left if name not in d[0]]
                gone += here
                removed[name] += len(here)
                rows.append((part, "".join(order), step, len(left), len(here), redundant, sum(d[0] == name for d in held),
                             sum(d[1] for d in here), sum(d[2] for d in here), name))
        out += [(*row[:-1], removed[row[-1]]) for row in rows]
    return sorted(out)


def run(spark, docs, labels):
    got = audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    return sorted(tuple(r) for r in got.select("part", "filter_order", "step", *audit.COLUMNS).collect())


@settings(max_examples=300, deadline=None)
@given(st.text("aA b\t\n\x0b\x1c\x85　#é😀", max_size=40), st.sampled_from([1, 13, 25, 60]))
def test_own_filters(text, times):
    text = text * times
    mask = audit.own_mask(text.encode())
    assert "".join(name for k, name in enumerate("ABCD") if mask >> k & 1) == fails_alone(text)


def test_orders_copies_and_labels(spark):
    docs = [
        (1, LONG, "a"), (2, LONG, "b"), (3, LONG + " #", "a"), (4, LONG + " #", "a"), (5, "SHORT #", "a"), (6, "SHORT #", "b"),
        (7, "same " * 80, "b"), (8, None, "a"), (9, "", "a"), (10, LONG.upper(), None), (11, LONG.upper(), ""),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (4, 1, 1), (4, 0, 0), (5, None, 1), (6, 1, None), (99, 1, 1), (None, 1, 1)]
    assert run(spark, docs, labels) == plain(docs, labels)


def test_null_and_repeated_ids(spark):
    docs = [
        (None, LONG, "a"), (None, LONG, "a"), (5, LONG, "a"), (5, LONG, "a"), (6, LONG, "a"), (5, "other", "a"),
        (4, "other", "b"), (4, "third", "b"), (7, "third", "b"), (-1, "negative", "b"), (0, "negative", "b"),
    ]
    assert run(spark, docs, [(5, 1, 1), (5, 1, 0)]) == plain(docs, [(5, 1, 1), (5, 1, 0)])


def test_large_group_of_copies(spark):
    docs = [(i, LONG if i % 3 == 0 else f"{LONG} {i}", f"s{i % 2}") for i in range(900)]
    got = run(spark, docs, [])
    assert got == plain(docs, [])
    first = next(r for r in got if r[:3] == ("s0", "EABCD", 1))
    assert first[4] == 149


def test_no_documents(spark):
    assert run(spark, [], []) == []


def test_filter_clears_unique_texts(spark):
    docs = [(i, f"{LONG} {i % 1900}", "a") for i in range(2000)]
    rows = audit.marked(spark.createDataFrame(docs, DOCS)).collect()
    held = {r.doc_id for r in rows if r.text is not None}
    repeated = {i for i in range(2000) if i % 1900 < 100}
    assert repeated <= held and len(held - repeated) < 100
    assert len(rows) == 2000


def test_crowded_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(audit, "MAX_BLOCKS", 1)
    docs = [(i, f"{LONG} {i % 2900}", "a") for i in range(3000)]
    assert run(spark, docs, []) == plain_copies(docs)


def plain_copies(docs):
    masks = {}
    seen = set()
    for _, text, _ in docs:
        own = fails_alone(text) + ("E" if text in seen else "")
        seen.add(text)
        masks[own] = masks.get(own, 0) + 1
    assert set(masks) == {"", "E"}
    out = []
    for order in itertools.permutations("ABCDE"):
        for step, name in enumerate(order, 1):
            e = masks["E"] if name == "E" else 0
            kept = masks[""] + (0 if "E" in order[:step] else masks["E"])
            out.append(("a", "".join(order), step, kept, e, 0, e, 0, 0, e * 120))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_sketch_does_not_depend_on_partitions(spark, monkeypatch, parts):
    monkeypatch.setattr(audit, "GATHERED", 100)
    hashes = spark.range(3000).selectExpr("xxhash64(id % 2500) AS h").repartition(parts)
    got = {r.block: r.repeated for r in audit.merged_sketch(hashes, 12).collect()}
    want = {r.block: r.repeated for r in audit.merged_sketch(hashes.coalesce(1), 12).collect()}
    assert got == want and len(got) == 12


def test_very_long_text(spark):
    docs = [(1, "word " * 400_000, "a"), (2, "word " * 400_000, "a"), (3, "x" * 2_000_000, "a")]
    assert run(spark, docs, []) == plain(docs, [])


def test_other_columns(spark):
    docs = spark.createDataFrame([(1, LONG, "a", 3, "m")], DOCS + ", h int, mask string")
    labels = spark.createDataFrame([(1, 1, 1, 0)], LABELS + ", part int")
    assert audit.audit(docs, labels).columns == ["part", "filter_order", "step", *audit.COLUMNS]
