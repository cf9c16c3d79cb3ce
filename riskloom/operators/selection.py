"""Exact order statistics and splits without a global sort in one task."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values of one open bracket that may be gathered into one array.
BRACKET_LIMIT = 10_000
ACCURACY = 10_000


@dataclass
class _Target:
    column: str
    rank: int
    lo: Any = None
    hi: Any = None
    below: int = 0
    inside: int = 0
    value: Any = None
    done: bool = False

    def bracket(self) -> Column:
        c = F.col(self.column)
        cond = c.isNotNull() & ~F.isnan(c.cast("double"))  # a missing value may also be written as NaN
        if self.lo is not None:
            cond = cond & (c > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (c < F.lit(self.hi))
        return F.when(cond, c)


def order_values(df: DataFrame, wanted: list[tuple[str, int]], counts: dict[str, int]) -> list[Any]:
    """Exact value at each (column, zero-based rank) of the ascending non-null values.

    Each round narrows all brackets at once: one pass takes approximate quantiles around the wanted
    rank, a second one counts the rows below, at and between them. A bracket shrinks by about
    ``ACCURACY / 4`` per round; what is left is gathered once it holds at most ``BRACKET_LIMIT`` values.
    """
    targets = [_Target(c, r, inside=counts[c]) for c, r in wanted]
    for t in targets:
        if not 0 <= t.rank < counts[t.column]:
            t.done = True
    while True:
        wide = [t for t in targets if not t.done and t.inside > BRACKET_LIMIT]
        if not wide:
            break
        quantiles = []
        for i, t in enumerate(wide):
            p, step = (t.rank - t.below) / max(1, t.inside - 1), 2.0 / ACCURACY
            share = F.array(F.lit(max(0.0, p - step)), F.lit(min(1.0, p + step)))
            quantiles.append(F.percentile_approx(t.bracket(), share, ACCURACY).alias(f"q{i}"))
        marks = df.agg(*quantiles).first()
        tallies = []
        for i, t in enumerate(wide):
            c, (lo, hi) = t.bracket(), marks[i]
            for tag, cond in (("a", c < F.lit(lo)), ("b", c == F.lit(lo)), ("c", (c > F.lit(lo)) & (c < F.lit(hi))),
                              ("d", c == F.lit(hi))):
                tallies.append(F.count_if(cond).alias(f"{tag}{i}"))
        tally = df.agg(*tallies).first()
        for i, t in enumerate(wide):
            lo, hi = marks[i]
            under, at_lo, between, at_hi = (tally[f"{tag}{i}"] for tag in "abcd")
            r = t.rank - t.below
            if r < under:
                t.hi, t.inside = lo, under
            elif r < under + at_lo:
                t.value, t.done = lo, True
            elif r < under + at_lo + between:
                t.lo, t.hi, t.below, t.inside = lo, hi, t.below + under + at_lo, between
            elif r < under + at_lo + between + at_hi:
                t.value, t.done = hi, True
            else:
                gone = under + at_lo + between + at_hi
                t.lo, t.below, t.inside = hi, t.below + gone, t.inside - gone
    rest = [t for t in targets if not t.done]
    if rest:
        arrays = df.agg(*[
            F.get(F.sort_array(F.collect_list(t.bracket())), t.rank - t.below).alias(f"v{i}")
            for i, t in enumerate(rest)
        ]).first()
        for i, t in enumerate(rest):
            t.value = arrays[i]
    return [t.value for t in targets]


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Interpolated median per column, exact on any number of rows."""
    n = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).alias(c) for c in cols]).first().asDict()
    wanted = [(c, r) for c in cols for r in ((n[c] - 1) // 2, n[c] // 2)]
    values = order_values(df, wanted, n)
    out = {}
    for i, c in enumerate(cols):
        lo, hi = values[2 * i], values[2 * i + 1]
        out[c] = None if n[c] == 0 else (lo + hi) / 2
    return out


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    fill = {c: v for c, v in exact_medians(df, cols).items() if v is not None}
    return df.na.fill(fill) if fill else df


def head_split(
    df: DataFrame, key: str, share: float = 0.7, out: str = "split", keys: DataFrame | None = None
) -> DataFrame:
    """First ``share`` of the rows by a unique key are 'train', the others 'val'.

    ``keys`` may name a cheaper frame with the same keys, such as the table the features were derived from.
    """
    source = (df if keys is None else keys).select(key)
    n = source.agg(F.count(key)).first()[0]
    cut = int(n * share)
    if cut == 0:
        return df.withColumn(out, F.lit("val"))
    bound = order_values(source, [(key, cut - 1)], {key: n})[0]
    return df.withColumn(out, F.when(F.col(key) <= F.lit(bound), "train").otherwise("val"))


def hash_split(df: DataFrame, key: str, seed: int = 42, out: str = "split") -> DataFrame:
    """Seeded 70/30 split that depends on the key alone, not on partitions or row order."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10)
    return df.withColumn(out, F.when(bucket.cast("bigint") % 10 < 7, "train").otherwise("val"))


def head_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of at most n rows: the n smallest hashes of the key."""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_mark", mark).orderBy("_mark", key).limit(n).drop("_mark")
