"""Scoring engines: named functions from frame to frame that add ``score``, ``decision`` and ``engine``."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.functions import text as X
from riskloom.models.documents import FRAUD_MODEL, PairModel, shortcut_score
from riskloom.operators.joins import agreement

FEATURES = ("semantic_risk", "velocity_1h", "proxy_score", "amount_deviation")

Engine = Callable[[DataFrame], DataFrame]
ENGINES: dict[str, Engine] = {}
DEFAULT_ENGINE = "hash"
ENGINE_VARIABLE = "RISKLOOM_ENGINE"


def engine(name: str) -> Callable[[Callable], Callable]:
    def register(fn: Callable) -> Callable:
        ENGINES[name] = fn
        return fn

    return register


def _decided(df: DataFrame, score, name: str) -> DataFrame:
    return df.withColumn("score", score).withColumns(
        {"decision": S.decision(F.col("score")), "engine": F.lit(name)}
    )


@engine("hash")
def hash_engine(df: DataFrame) -> DataFrame:
    text = F.concat(*[X.float_text(F.coalesce(F.col(c), F.lit(0.0))) for c in FEATURES])
    return _decided(df, F.round(S.md5_percent(text), 2), "hash")


@engine("pair_model")
def pair_engine(df: DataFrame, model: PairModel | None = None) -> DataFrame:
    """Two-layer score on x1..x4: semantic risk, velocity / 50, proxy score, amount deviation."""
    m = model or PairModel.from_document(FRAUD_MODEL)
    x = {
        "x1": F.col("semantic_risk"), "x2": F.col("velocity_1h") / F.lit(50.0), "x3": F.col("proxy_score"),
        "x4": F.col("amount_deviation"),
    }
    z = {f"z{i + 1}": n.column(x) for i, n in enumerate(m.nodes)}
    return _decided(df, S.clip01(m.master.column(z)), "pair_model")


@engine("pair_shortcut")
def shortcut_engine(df: DataFrame, model: PairModel | None = None) -> DataFrame:
    """Compatibility: master coefficients on raw features."""
    m = model or PairModel.from_document(FRAUD_MODEL)
    return _decided(df, shortcut_score(m, list(FEATURES)), "pair_shortcut")


@engine("reply")
def reply_engine(df: DataFrame) -> DataFrame:
    """Score parsed from a text reply in the column ``response``; an empty reply gives 0.5."""
    if "response" not in df.columns:
        raise ValueError("the reply engine needs a column 'response'")
    return _decided(df, X.reply_score(F.coalesce(F.col("response"), F.lit(""))), "reply")


def get_engine(name: str | None = None) -> Engine:
    """Engine by name, else by environment variable; an unknown name gives the default engine."""
    return ENGINES.get(name or os.environ.get(ENGINE_VARIABLE, DEFAULT_ENGINE), ENGINES[DEFAULT_ENGINE])


def compare_engines(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Scores and decisions of several engines side by side; an engine that fails gives null and 'ERROR'."""
    out = df
    for name in names:
        try:
            scored = get_engine(name)(out)
            scored.schema  # a frame that does not fit fails here, when its plan is resolved
            out = scored.withColumnsRenamed({"score": f"{name}_score", "decision": f"{name}_decision"}).drop("engine")
        except Exception:  # whatever an engine fails with, the others are still compared
            out = out.withColumns({f"{name}_score": F.lit(None).cast("double"), f"{name}_decision": F.lit("ERROR")})
    cells = [c for n in names for c in (f"{n}_score", f"{n}_decision")]
    return out.select(key, *cells, agreement([f"{n}_decision" for n in names]).alias("agree"))
