"""URL filter: host and path rules, then a blocked Bloom filter in front of an exact join with listed URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import lower_ascii

#: (rule, verdict); a rule is a host, a slash and the start of a path.
RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Blocks of the filter: 32 bytes each, so the broadcast table has 2 MB at most, whatever the length of the list.
BLOCKS = 1 << 15
WORDS = 8
#: Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_of(url: Column) -> Column:
    """Host without user, default port and ``www.``, path without trailing slashes, query without tracking parameters;
    scheme and fragment are dropped. Empty when there is no ``://``."""
    host = host_of(url)
    for dropped in (r"^.*@", r"^www\.", r":(80|443)$"):
        host = F.regexp_replace(host, dropped, "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(TRACKING)), "&")
    return F.when(host_of(url) == "", F.lit("")).otherwise(
        F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked first
        own, slash, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def masks_of(key: Column) -> list[Column]:
    """One bit in each word of the key's block."""
    bits = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1)
    return [
        F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 5 * i).bitwiseAND(31).cast("int"))
        for i in range(WORDS)
    ]


def bloom_filter(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0 .. w7) of all keys; at most ``blocks`` rows, united map-side."""
    masks = masks_of(F.col(key))
    rows = keys.select(block_of(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(
    pages: DataFrame, listed: DataFrame, rules=RULES, blocks: int = BLOCKS, page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict and whether the canonical URL is listed, one row per row of ``pages``.

    The rule's verdict holds, else a URL is blocked when its canonical form is that of a URL of ``listed`` (a frame
    with a column ``url``). Only rows that pass the Bloom filter meet the exact hash join; the others are shuffled
    nowhere. A full filter passes more rows and changes no verdict.

    Null URLs and those without ``://`` have an empty host and path, no rule, and are allowed. Repeated rows stay.
    Either frame may be empty. Columns other than the two named are ignored.
    """
    canonical = canonical_of(F.col("url"))
    keys = listed.select(canonical.alias("key")).filter(F.col("key") != "").distinct()
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = (
        pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
        .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                canonical.alias("key"))
        .withColumns({"rule": rule, "by_rule": verdict, "block": block_of(F.col("key"), blocks)})
    )
    held = F.broadcast(bloom_filter(keys, "key", blocks))
    all_bits = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(masks_of(F.col("key")))]
    possible = F.coalesce(reduce(lambda a, b: a & b, all_bits) & (F.col("key") != ""), F.lit(False))
    probed = rows.join(held, "block", "left").withColumn("possible", possible)
    out = ["page_id", "host", "path", "rule", "by_rule", "listed"]
    misses = probed.filter(~F.col("possible")).withColumn("listed", F.lit(False)).select(*out)
    exact = keys.withColumn("listed", F.lit(True))
    hits = probed.filter("possible").join(exact, "key", "left").withColumn(
        "listed", F.coalesce(F.col("listed"), F.lit(False))
    )
    return misses.unionByName(hits.select(*out)).select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("by_rule"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed",
    )
