"""Confusion counts, threshold metrics, ranking metrics and losses as one-row frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import cap as at_most
from riskloom.functions.scalar import clip01
from riskloom.operators.prefix import running_totals, value_sums
from riskloom.session import materialize

EPS = 1e-8

# Least metrics a model must reach before it may score.
GATE_THRESHOLDS = {"f1": 0.45, "precision": 0.50, "recall": 0.40, "auc_roc": 0.78}

# Threshold grids, as (first, last, step).
SWEEP_GRID = (0.05, 0.95, 0.05)
BEST_F1_GRID = (0.10, 0.85, 0.05)
COARSE_GRID = (0.3, 0.9, 0.1)


def grid(first: float, last: float, step: float) -> list[float]:
    n = round((last - first) / step)
    return [round(first + i * step, 10) for i in range(n + 1)]


def known(score: Column) -> Column:
    """A missing score counts as 0, as in the source's number parser, so no row leaves the counts."""
    return F.coalesce(score.cast("double"), F.lit(0.0))


def positive(label: str) -> Column:
    return F.coalesce(F.col(label) == 1, F.lit(False))


def flagged(score: Column, threshold: float | Column, inclusive: bool = False) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return score >= t if inclusive else score > t


def confusion(
    df: DataFrame, score: str = "score", label: str = "is_fraud", threshold: float | Column = 0.5,
    inclusive: bool = False, by: Sequence[str] = (),
) -> DataFrame:
    hit, pos = flagged(known(F.col(score)), threshold, inclusive), positive(label)
    return df.groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"),
    )


def ratio(a: Column, b: Column, eps: float = 0.0) -> Column:
    """a / b with 0 for an empty denominator, or a / (b + eps)."""
    if eps:
        return a / (b + F.lit(eps))
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def with_prf(counts: DataFrame, eps: float = 0.0) -> DataFrame:
    df = counts.withColumns({
        "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp"), eps),
        "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"), eps),
    })
    p, r = F.col("precision"), F.col("recall")
    return df.withColumn("f1", ratio(F.lit(2.0) * p * r, p + r, eps))


def with_accuracy(counts: DataFrame) -> DataFrame:
    right, n = F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return counts.withColumn("accuracy", ratio(right, n))


def score_counts(df: DataFrame, score: str = "score", label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score as a stage table: all metrics follow from it in later passes."""
    pos = F.when(positive(label), 1).otherwise(0)
    rows = df.select(*by, known(F.col(score)).alias("score"), pos.alias("pos"), (F.lit(1) - pos).alias("neg"))
    return value_sums(rows, "score", ["pos", "neg"], list(by))


def roc_points(df: DataFrame, score: str = "score", label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from high to low: positives and negatives at the score and above it."""
    counts = score_counts(df, score, label, by)
    rows = running_totals(counts, "score", ["pos", "neg"], list(by), descending=True, summed=True)
    return rows.select(
        *by, "score", "pos", "neg", (F.col("pos") + F.col("pos_before")).alias("cum_pos"),
        (F.col("neg") + F.col("neg_before")).alias("cum_neg"),
    )


def auc_of_counts(counts: DataFrame, one_class: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    rows = running_totals(counts, "score", ["pos", "neg"], list(by), summed=True)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    pairs = pos * F.col("neg_before") + pos * neg / F.lit(2.0)
    sums = rows.groupBy(*by).agg(
        F.sum(pairs).alias("_pairs"), F.sum(pos).alias("_pos"), F.sum(neg).alias("_neg")
    )
    value = F.try_divide(F.col("_pairs"), F.col("_pos") * F.col("_neg"))
    return sums.select(*by, F.coalesce(value, F.lit(one_class)).alias("auc_roc"))


def auc(
    df: DataFrame, score: str = "score", label: str = "is_fraud", one_class: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half (average ranks)."""
    return auc_of_counts(score_counts(df, score, label, by), one_class, by)


def confusion_of_counts(
    counts: DataFrame, threshold: float | Column, inclusive: bool = False, by: Sequence[str] = (),
) -> DataFrame:
    hit = flagged(F.col("score"), threshold, inclusive)

    def total(c: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))

    return counts.groupBy(*by).agg(
        total("pos", hit).alias("tp"), total("neg", hit).alias("fp"),
        total("pos", ~hit).alias("fn"), total("neg", ~hit).alias("tn"),
    )


def auc_trapezoid(df: DataFrame, score: str = "score", label: str = "is_fraud", one_class: float = 0.5) -> DataFrame:
    """Area under the ROC points by trapezoids; equal scores form one sloped step."""
    p = roc_points(df, score, label)
    neg, pos = F.col("neg").cast("double"), F.col("pos").cast("double")
    area = neg * (F.col("cum_pos") + F.col("cum_pos") - pos) / F.lit(2.0)
    sums = p.agg(F.sum(area).alias("_area"), F.sum(pos).alias("_pos"), F.sum(neg).alias("_neg"))
    value = F.try_divide(F.col("_area"), F.col("_pos") * F.col("_neg"))
    return sums.select(F.coalesce(value, F.lit(one_class)).alias("auc_roc"))


def evaluate(
    df: DataFrame, score: str = "score", label: str = "is_fraud", threshold: float = 0.5, inclusive: bool = False,
    one_class: float = 0.0, by: Sequence[str] = (), accuracy: bool = False,
) -> DataFrame:
    """Precision, recall, F1, AUC and confusion counts; no rows give zeros. The input is read once."""
    table = score_counts(df, score, label, by)
    counts = with_prf(confusion_of_counts(table, threshold, inclusive, by))
    if accuracy:
        counts = with_accuracy(counts)
    rank = auc_of_counts(table, one_class, by)
    if by:
        return counts.join(rank, list(by), "left")
    return counts.withColumn("auc_roc", rank.scalar())


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float], score: str = "score", label: str = "is_fraud", inclusive: bool = True,
    min_precision: float = 0.5, min_recall: float = 0.4,
) -> DataFrame:
    """Metrics at every threshold from one pass.

    Every row counts once under the number of thresholds it passes; the counts at a threshold are then the running
    totals of a frame with one row per threshold.
    """
    ts = sorted(thresholds)
    passed = F.lit(0)
    for t in ts:
        passed = passed + flagged(known(F.col(score)), t, inclusive).cast("int")
    pos = F.when(positive(label), 1).otherwise(0)
    levels = df.select(passed.alias("level"), pos.alias("pos"), (F.lit(1) - pos).alias("neg"))
    levels = levels.groupBy("level").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid_rows = df.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate([float("nan"), *ts])], "level int, threshold double"
    )
    w = Window.partitionBy(F.lit(0))
    above = w.orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = grid_rows.join(F.broadcast(levels), "level", "left").na.fill(0, ["pos", "neg"])
    counts = every.select(
        "level", "threshold", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(w).alias("_pos"), F.sum("neg").over(w).alias("_neg"),
    )
    counts = counts.filter("level > 0").select(
        "threshold", "tp", "fp", (F.col("_pos") - F.col("tp")).alias("fn"), (F.col("_neg") - F.col("fp")).alias("tn")
    )
    return with_prf(counts).withColumns({
        "precision_ok": F.col("precision") >= min_precision, "recall_ok": F.col("recall") >= min_recall,
    })


def best_f1(sweep: DataFrame, fallback: float = 0.5) -> DataFrame:
    """First threshold with the highest F1; the fallback when every F1 is 0."""
    top = sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)
    return top.withColumn("threshold", F.when(F.col("f1") > 0, F.col("threshold")).otherwise(fallback))


def feasible(sweep: DataFrame) -> DataFrame:
    return sweep.agg(F.coalesce(F.bool_or(F.col("precision_ok") & F.col("recall_ok")), F.lit(False)).alias("feasible"))


def squared_errors(df: DataFrame, pred: Column, label: Column) -> DataFrame:
    clipped = clip01(pred)
    return df.agg(
        F.avg((pred - label) * (pred - label)).alias("mse"),
        F.avg((clipped - label) * (clipped - label)).alias("mse_clipped"),
    ).withColumns({"rmse": F.sqrt("mse"), "rmse_clipped": F.sqrt("mse_clipped")})


def log_loss_term(p: Column, y: Column) -> Column:
    return -(y * F.log(p + F.lit(EPS)) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p + F.lit(EPS)))


def log_loss(df: DataFrame, p: Column, y: Column, weight: float = 1.0) -> DataFrame:
    term = log_loss_term(p, y)
    w = F.when(y == 1, F.lit(weight)).otherwise(1.0)
    return df.agg(F.avg(term).alias("log_loss"), F.avg(w * term).alias("weighted_log_loss"))


def focal_loss(df: DataFrame, p: Column, y: Column, gamma: float = 2.0) -> DataFrame:
    right = F.when(y == 1, p).otherwise(F.lit(1.0) - p)
    term = F.pow(F.lit(1.0) - right, F.lit(gamma)) * log_loss_term(p, y)
    return df.agg(F.avg(term).alias("focal_loss"))


def class_weight(df: DataFrame, label: str = "is_fraud", cap: float = 12.0) -> DataFrame:
    rate = F.avg(F.col(label).cast("double"))
    raw = (F.lit(1.0) - rate) / (rate + F.lit(EPS))
    return df.agg(rate.alias("rate"), raw.alias("raw_weight"), at_most(raw, cap).alias("weight"))


def average_ranks(df: DataFrame, score: str = "score", out: str = "avg_rank") -> DataFrame:
    """The rows with the average rank of their score, equal scores sharing the mean of their places, from 1 on.

    A null score counts as 0, as in all metrics; NaN ranks above all numbers. Places come from counts per score and
    from totals of earlier value ranges, so no task sorts more than a range of distinct scores, and rows of a score that
    very many share meet one row of counts.
    """
    key = F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    rows = materialize(df.withColumn("_score", F.when(key == 0, F.lit(0.0)).otherwise(key)), "ranked")
    counts = running_totals(rows.select("_score", F.lit(1).alias("_n")), "_score", ["_n"])
    places = counts.select("_score", (F.col("_n_before") + 1 + (F.col("_n") - 1) / F.lit(2.0)).alias(out))
    return rows.join(places, "_score", "left").select(*df.columns, out)
