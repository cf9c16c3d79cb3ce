"""Column rules: tolerant casts, feature rules, scores, labels and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# E-mail domains counted as high risk (an empty domain counts too).
RISKY_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "anonymous.com", "")

# Scales of the raw card data set.
AMOUNT_SCALE = 500.0
TIME_SCALE = 15_811_131.0

# Numbers with single underscores between digits.
NUMBER_TEXT_JOINED = r"^[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?)$"


def cap(c: Column, hi: float) -> Column:
    """At most ``hi``. A null stays null: least() and greatest() would skip it. NaN counts as large."""
    return F.when(c > hi, F.lit(hi)).otherwise(c)


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.when(c > hi, F.lit(hi)).when(c < lo, F.lit(lo)).otherwise(c)


def clip01(c: Column) -> Column:
    return clip(c, 0.0, 1.0)


def parse_number(c: Column) -> Column:
    """Number in a text column, null when the text is no number.

    Plain texts need no pattern: Java reads more than the source's float parser only in suffixes ("0.5f") and hex
    floats. Texts with "_" between digits are rare and take the pattern.
    """
    text = F.trim(c.cast("string"), F.lit(" \t\n\r\x0b\x0c"))
    suffix = F.lower(F.right(text, F.lit(1))).isin("f", "d") & ~F.lower(F.right(text, F.lit(3))).isin("inf")
    foreign = suffix | text.contains("x") | text.contains("X")
    joined = F.when(text.rlike(NUMBER_TEXT_JOINED), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(text.contains("_"), joined).when(~foreign, text.try_cast("double"))


def to_number(c: Column, numeric: bool = False) -> Column:
    """Number or 0; ``numeric`` says that the column holds numbers already and needs no parsing."""
    return F.coalesce(c.cast("double") if numeric else parse_number(c), F.lit(0.0))


def to_unit_interval(c: Column, numeric: bool = False) -> Column:
    """Tolerant number clamped to [0, 1]; NaN sorts above all numbers and so becomes 1."""
    return clip01(to_number(c, numeric))


def to_binary(c: Column, numeric: bool = False) -> Column:
    x = to_number(c, numeric)
    return F.when(~F.isnan(x) & (x > 0), 1).otherwise(0)


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame, candidates: Sequence[str]) -> bool:
    """Whether all candidates the frame has hold numbers."""
    types = dict(df.dtypes)
    return all(types[c].split("(")[0] in NUMERIC_TYPES for c in candidates if c in types)


def first_of(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First candidate column that is neither null nor ''; columns the frame lacks are skipped."""
    present = [F.col(c) for c in candidates if c in df.columns]
    if not present:
        return F.lit(None).cast("string")
    if numeric_columns(df, candidates):
        return F.coalesce(*[c.cast("double") for c in present])
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in present])


# Candidate columns per feature, in order of preference.
FIELD_CANDIDATES = {
    "semantic_risk": ("semantic_risk", "DeviceInfo", "cardholder_risk", "TransactionAmt"),
    "velocity_1h": ("velocity_1h", "tx_count_1h", "TransactionDT"),
    "proxy_score": ("proxy_score", "proxy_flag", "Proxy"),
    "amount_deviation": ("amount_deviation", "TransactionAmt"),
    "is_fraud": ("is_fraud", "isFraud", "Class"),
}
FIELD_CASTS = {
    "semantic_risk": to_unit_interval,
    "velocity_1h": to_number,
    "proxy_score": to_unit_interval,
    "amount_deviation": to_number,
    "is_fraud": to_binary,
}


def normalize_benchmark(df: DataFrame, source_type: str = "ieee_cis", keep: Sequence[str] = ()) -> DataFrame:
    """Raw fraud table of any supported layout -> the five feature columns."""
    if (source_type or "ieee_cis").lower() != "ieee_cis":
        raise ValueError(f"unsupported benchmark source: {source_type}")
    features = [
        FIELD_CASTS[name](first_of(df, names), numeric_columns(df, names)).alias(name)
        for name, names in FIELD_CANDIDATES.items()
    ]
    return df.select(*keep, *features)


def _text(c: str) -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def _number_or_zero_text(c: str) -> Column:
    """A missing field reads as 0, text that is no number as null."""
    return parse_number(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("0")))


def with_parsed(df: DataFrame) -> DataFrame:
    """Numbers of the raw card columns, parsed once per row for all rules."""
    return df.withColumns({
        "_amount": _number_or_zero_text("TransactionAmt"), "_seconds": _number_or_zero_text("TransactionDT"),
        "_address": _number_or_zero_text("addr1"),
    })


def ieee_semantic_risk() -> Column:
    device, amount = _text("DeviceInfo"), F.nanvl(F.col("_amount"), F.lit(0.0))
    debit = _text("card4").isin("visa", "mastercard") & (_text("card6") == "debit")
    risk = (
        F.lit(0.2)
        + F.when(device.isin("", "nan"), 0.2).otherwise(0.0)
        + F.when(debit, 0.15).otherwise(0.0)
        + F.when(_text("DeviceType") == "mobile", 0.1).otherwise(0.0)
        + F.when(amount > 300, 0.2).when(amount > 100, 0.05).otherwise(0.0)
    )
    return F.round(cap(risk, 1.0), 6)


def ieee_velocity() -> Column:
    return F.round(F.coalesce(cap(F.col("_seconds") / F.lit(TIME_SCALE), 1.0), F.lit(0.0)), 6)


def ieee_proxy_score() -> Column:
    address = F.col("_address")
    risk = (
        F.lit(0.1)
        + F.when(F.trim(_text("P_emaildomain")).isin(*RISKY_DOMAINS), 0.3).otherwise(0.0)
        + F.when(address.isNull() | (address == 0), 0.25).otherwise(0.0)
        + F.when(F.trim(_text("R_emaildomain")).isin(*RISKY_DOMAINS), 0.1).otherwise(0.0)
    )
    return F.round(cap(risk, 1.0), 6)


def ieee_amount_dev() -> Column:
    return F.round(F.coalesce(cap(F.col("_amount") / F.lit(AMOUNT_SCALE), 1.0), F.lit(0.0)), 6)


# The rules read the columns that with_parsed() adds.
IEEE_RULES = {
    "semantic_risk": ieee_semantic_risk, "velocity_1h": ieee_velocity, "proxy_score": ieee_proxy_score,
    "amount_deviation": ieee_amount_dev,
}


def prepare_ieee_cis(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return with_parsed(df).select(
        *keep, *[rule().alias(name) for name, rule in IEEE_RULES.items()], to_binary(F.col("isFraud")).alias("is_fraud")
    )


def md5_percent(c: Column) -> Column:
    """(first 32 bits of the MD5) mod 100 as a share."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint") % F.lit(100) / F.lit(100.0)


def decision(score: Column, threshold: float = 0.55) -> Column:
    return F.when(score > threshold, "BLOCK").otherwise("ALLOW")


def rule_score(sem: Column, vel: Column, proxy: Column) -> Column:
    return F.lit(0.5) * sem + F.lit(0.3) * proxy + F.lit(0.2) * cap(vel / F.lit(20.0), 1.0)


def weighted_score(weights: dict[str, float], sem: Column, vel: Column, proxy: Column, amt: Column) -> Column:
    total = (
        F.lit(weights.get("semantic_risk", 0.0)) * sem
        + F.lit(weights.get("proxy_score", 0.0)) * proxy
        + F.lit(weights.get("velocity_1h", 0.0)) * cap(vel / F.lit(20.0), 1.0)
        + F.lit(weights.get("amount_deviation", 0.0)) * cap(amt / F.lit(1000.0), 1.0)
    )
    return clip01(total)


def pseudo_score(sem: Column, proxy: Column, amt: Column) -> Column:
    return F.lit(0.4) * sem + F.lit(0.3) * proxy + F.lit(0.15) * (sem * amt)


def risk_value(sem: Column, vel: Column, proxy: Column, amt: Column) -> Column:
    return (
        F.lit(0.4) * sem
        + F.lit(0.05) * vel / F.lit(50.0)
        + F.lit(0.3) * proxy
        + F.lit(0.15) * sem * amt
    )


def efficiency_value(latency: Column, auth: Column, cpu: Column) -> Column:
    x1, x3 = latency / F.lit(2000.0), cpu / F.lit(100.0)
    raw = F.lit(0.6) * (F.lit(1.0) - x1) + F.lit(0.3) * auth - F.lit(0.4) * x1 * x3 - F.lit(0.1) * x3 * x3
    return clip01(raw)


def health_status(score: Column) -> Column:
    return F.when(score > 0.75, "OK").when(score > 0.45, "WARN").otherwise("CRITICAL")


def usage_band(peak: Column, limit: Column) -> Column:
    ratio = F.when(limit > 0, F.try_divide(peak.cast("double"), limit)).otherwise(0.0)
    return F.when(ratio >= 0.9, "CRITICAL").when(ratio >= 0.7, "WARNING").otherwise("NORMAL")


def iso_timestamp(*candidates: Column) -> Column:
    """First non-empty candidate parsed as ISO time in UTC; text that is no time gives null."""
    text = F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})\s*$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.coalesce(F.try_to_timestamp(zoned), F.try_to_timestamp(text)))
