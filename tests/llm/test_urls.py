import pytest

from riskloom.llm import urls

CASES = [
    # url, host, path, rule, verdict without a list
    ("http://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12?x=1", "example.org", "/en/12", "example.org/en/1", "block"),
    ("HTTP://EXAMPLE.ORG/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"),
    ("https://x.com/fr/9#a", "x.com", "/fr/9", "com/fr/", "allow"),
    ("https://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("https://x.com/de", "x.com", "/de", None, "allow"),
    ("http://a.org", "a.org", "", None, "allow"),
    ("http://a.org?q=/x", "a.org", "", None, "allow"),
    ("no scheme/x", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://É.NET:80/a//b", "É.net:80", "/a//b", None, "allow"),
]


@pytest.mark.parametrize("blocks", [1, urls.BLOCKS])
def test_rules_and_list(spark, blocks):
    rows = [(k, c[0], "clash", True) for k, c in enumerate(CASES)]
    rows += [(100, "http://bad.net/p/?utm_source=a#z", "", True), (101, "https://WWW.bad.net:443/p", "", True),
             (102, "http://bad.net/P", "", True), (103, "http://bad.net/p?id=1&ref=x", "", True), (103, "http://bad.net/p?id=1", "", True)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, listed boolean")
    listed = spark.createDataFrame([("https://bad.net/p",), ("http://bad.net/p?id=1",), (None,), ("",)], "url string")
    got = {}
    for r in urls.judge(pages, listed, blocks=blocks).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    for k, (_, *wanted) in enumerate(CASES):
        assert got[k] == [tuple(wanted)]
    assert [got[k][0][3] for k in (100, 101, 102)] == ["block", "block", "allow"]
    assert [g[3] for g in got[103]] == ["block", "block"]


def test_empty_frames(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, url string")
    assert [r.verdict for r in urls.judge(pages, none).collect()] == ["allow"]
    assert urls.judge(none, pages).count() == 0


def test_filter_has_no_misses_and_few_false_hits(spark):
    from functools import reduce

    from pyspark.sql import functions as F

    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    others = spark.range(5000).select(F.concat(F.lit("o"), "id").alias("key"))
    held = urls.bloom_filter(keys, "key", 1 << 10)
    hit = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(urls.masks_of(F.col("key")))])

    def hits(frame):
        return frame.withColumn("block", urls.block_of(F.col("key"), 1 << 10)).join(held, "block").filter(hit).count()

    assert hits(keys) == 5000
    assert hits(others) < 100
