import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.functions import text as X
from riskloom.functions.vector import cosine_distance
from riskloom.models.engines import compare_engines, get_engine, hash_engine


def test_numbers_follow_the_float_parser(spark):
    texts = ["", " 1.5 ", "abc", "nan", "inf", "-inf", "-3", "0.5f", "1e3", "1_000", "_1", "1__0", ".5", "5.", "0x10", "1d", "+7", None]

    def expected(t):
        try:
            return float(t)
        except (TypeError, ValueError):
            return None

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", S.parse_number(F.col("t")).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = expected(t)
        assert got[i] == want or (want is not None and math.isnan(want) and math.isnan(got[i])), t


def test_unit_interval_and_binary_of_nan(spark):
    row = spark.createDataFrame([("nan",)], "t string").select(
        S.to_unit_interval(F.col("t")).alias("u"), S.to_binary(F.col("t")).alias("b")
    ).first()
    assert row.u == 1.0 and row.b == 0


def test_normalize_raw_rows(spark):
    raw = spark.createDataFrame(
        [("100.0", "1", "desktop", "0", "gift card", "0"), ("150.0", "2", "mobile", "1", "electronics", "1"), ("", "3", "mobile", "0", "office", "")],
        "TransactionAmt string, TransactionDT string, DeviceType string, proxy_flag string, merchant_name string, isFraud string",
    )
    rows = S.normalize_benchmark(raw).collect()
    assert [tuple(r) for r in rows] == [(1.0, 1.0, 0.0, 100.0, 0), (1.0, 2.0, 1.0, 150.0, 1), (0.0, 3.0, 0.0, 0.0, 0)]
    with pytest.raises(ValueError):
        S.normalize_benchmark(raw, "other")


def test_prepare_raw_rows(spark):
    names = ["DeviceInfo", "DeviceType", "card4", "card6", "P_emaildomain", "R_emaildomain", "addr1", "TransactionAmt", "TransactionDT", "isFraud"]
    rows = [
        (None, "Mobile", "Visa", "debit", " GMAIL.com", "x.org", "0", "301", "15811131", "1"),
        ("iOS", None, "visa", "credit", "x.org", None, "325.0", "junk", "junk", ""),
        ("nan", "desktop", "mastercard", "debit", None, "yahoo.com", "junk", "nan", None, "0"),
        ("iOS", "desktop", "discover", "debit", "x.org", "x.org", "87", "100.5", "31622262", "0"),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = [tuple(r) for r in S.prepare_ieee_cis(raw).collect()]
    assert got == [
        (0.85, 1.0, 0.65, 0.602, 1), (0.2, 0.0, 0.2, 0.0, 0), (0.55, 0.0, 0.75, 1.0, 0), (0.25, 1.0, 0.1, 0.201, 0),
    ]


def test_missing_features_stay_missing(spark):
    df = spark.createDataFrame([(None, 0.5)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    row = df.select(S.clip01(a), S.rule_score(b, a, b), S.weighted_score({"semantic_risk": 1.0}, a, b, b, b)).first()
    assert tuple(row) == (None, None, None)


def test_text_device_hides_the_amount(spark):
    raw = spark.createDataFrame([("Windows", "0.4"), ("", "0.4")], "DeviceInfo string, TransactionAmt string")
    assert [r.semantic_risk for r in S.normalize_benchmark(raw).collect()] == [0.0, 0.4]


def test_float_text_equals_repr(spark):
    rng = np.random.default_rng(1)
    values = [0.0, 12.0, 0.85, 1e-3, 1e-4, 1.5e-4, 1e-5, 2.5e-7, 1e7, 12345678.9, 1e15, 1.5e16, 1e16, 1e22, -1.25e-4, -2.5e9, 1e-100, 1.7e120, -0.0, 9999999.999, 0.001, 0.00099999, math.inf, -math.inf]
    values += list(rng.normal(size=50)) + list(rng.normal(size=50) * 1e-5) + list(rng.normal(size=50) * 1e10)
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", X.float_text(F.col("v")).alias("t"))
    assert [(r.v, r.t) for r in rows.collect() if r.t != repr(r.v)] == []


def test_reply_score(spark):
    cases = {"0.7": 0.7, "Score: 0,3": 0.0, "1.5 then 0.2": 0.2, "none": 0.5, "": 0.5, "0.5f": 0.5, "nan 0.1": 0.1, "a 0.25": 0.25, "-0.1 1": 1.0}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", X.reply_score(F.col("t")).alias("v"))
    assert {r.t: r.v for r in rows.collect()} == cases


def test_error_blocks_to_the_next_time_or_the_end(spark):
    head = "24/01/05 10:00:0{} ERROR Client: Application diagnostics message: User class threw exception: x{}"
    log = "\n".join(["24/01/05 10:00:00 INFO a", head.format(1, 1), "  at b", "24/01/05 10:00:02 INFO c", head.format(3, 2), "  at d"])
    rows = spark.createDataFrame([(log,), ("quiet",)], "t string")
    whole = [r[0] for r in rows.select(X.error_blocks(F.col("t"))).collect()]
    assert whole == ["\n".join([head.format(1, 1), "  at b", head.format(3, 2), "  at d"]), X.NO_BLOCKS]
    heads = [r[0] for r in rows.select(X.error_blocks(F.col("t"), whole_block=False)).collect()]
    assert heads[0] == head.format(1, 1) + "\n" + head.format(3, 2)


def test_error_lines_fall_back(spark):
    log = "a\nTraceback (most recent call last):\n  one\nip-1\nboom"
    rows = spark.createDataFrame([(log,), ("x\n ERROR - y",)], "t string")
    got = [r[0] for r in rows.select(X.error_lines(F.col("t"), words=["zzz"])).collect()]
    assert got == [["Traceback (most recent call last):", "  one", "boom"], [" ERROR - y"]]


def test_lint_output_without_array(spark):
    rows = spark.createDataFrame([(1, "] no ["), (2, "none"), (3, 'x [{"type": "fatal"}] y')], "k int, o string")
    got = X.explode_lint(rows, "o", ["k"]).collect()
    assert [tuple(r) for r in got] == [(3, "F", "unknown", "N/A", "N/A", 0)]


def test_cosine_distance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [-2.0, -2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(2.0) and got[2] is None


def test_engines(spark):
    rows = spark.createDataFrame([(1, 0.85, 12.0, 1.0, 2.1), (2, 0.2, 3.0, 0.0, 0.3)], "id int, semantic_risk double, velocity_1h double, proxy_score double, amount_deviation double")
    assert get_engine("no such engine") is hash_engine
    out = compare_engines(rows, "id", ["pair_shortcut", "hash", "reply"]).orderBy("id").collect()
    assert out[0].reply_decision == "ERROR" and out[0].reply_score is None
    assert out[0].pair_shortcut_score == pytest.approx(1.0)
    sem = -0.009689705844712562 + 0.8216057667849549 * 0.2 + 0.6615707085936392 * 3.0
    assert out[1].pair_shortcut_score == pytest.approx(min(1.0, max(0.0, sem)))
    with_reply = compare_engines(rows.withColumn("response", F.lit("0.9")), "id", ["reply"]).first()
    assert (with_reply.reply_score, with_reply.agree) == (0.9, "YES")
