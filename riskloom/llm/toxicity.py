"""Toxicity by a classifier chain of linear models over words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.exprs import let, lower_ascii, text_of
from riskloom.llm.quality import tokens
from riskloom.session import materialize

#: The chain: (category, SQL over a row of labels). The last one decides.
CATEGORIES = (("low_quality", "1 - quality"), ("toxic", "toxic"))
#: Features are the words of MIN_DOCS training documents at least whose share of a category's documents lies MIN_Z
#: standard deviations off what chance would give: the most telling ones, VOCABULARY at most.
VOCABULARY = 4096
MIN_DOCS = 5
MIN_Z = 4.0
#: Labelled documents that the models are fitted on: those of the least hashes of their ids.
TRAINING_DOCS = 20_000
FOLDS = 3
#: A word counts as repeated from these numbers of times on.
REPEATS = (2, 3)
#: The largest of 0.0004, 0.0001 and 0.00002 that, out of fold on sf0.1, loses no document with a single telling word.
REGULARISATION = 0.0001
THRESHOLD = 0.4


@dataclass
class Chain:
    """Fitted models in the order of their categories, and the words they know."""

    vocabulary: CountVectorizerModel
    models: list[tuple[str, LogisticRegressionModel]]


def terms(text: Column) -> Column:
    """The distinct words and runs of signs, in lower case; those that occur n times at least, for each n of REPEATS,
    also with a blank and n behind, which no word holds."""
    def repeated(row: Column, n: int) -> Column:
        held = F.array_distinct(F.filter(row, lambda w, i: w == F.get(row, i - (n - 1))))
        return F.transform(held, lambda w: F.concat(w, F.lit(f" {n}")))

    return let(
        F.sort_array(tokens(lower_ascii(text))),
        lambda row: F.concat(F.array_distinct(row), *[repeated(row, n) for n in REPEATS]),
    )


def with_words(rows: DataFrame, vocabulary: CountVectorizerModel) -> DataFrame:
    """``_words``: which of the known words a text holds, once and repeated."""
    return vocabulary.transform(rows).drop("_terms")


def telling_words(rows: DataFrame, categories=CATEGORIES) -> CountVectorizerModel:
    names = [f"_y_{c}" for c, _ in categories]
    n, *positive = rows.agg(F.count("*"), *[F.sum(y) for y in names]).first()
    found = rows.select(F.explode("_terms").alias("term"), *names).groupBy("term").agg(
        F.count("*").alias("docs"), *[F.sum(y).alias(y) for y in names]
    ).filter(F.col("docs") >= MIN_DOCS)
    shares = [(y, (p or 0.0) / n) for y, p in zip(names, positive)] if n else []
    off = [F.abs(F.col(y) - F.col("docs") * p) / F.sqrt(F.col("docs") * (p * (1 - p))) for y, p in shares if 0 < p < 1]
    if off:
        chosen = found.withColumn("z", F.greatest(F.lit(0.0), *off)).filter(F.col("z") >= MIN_Z)
        known = [r.term for r in chosen.orderBy(F.desc("z"), "term").limit(VOCABULARY).collect()]
    else:
        known = []
    return CountVectorizerModel.from_vocabulary(
        known or ["\n"], inputCol="_terms", outputCol="_words"  # a line feed is no word: without words all is zero
    ).setBinary(True)


def with_chain(rows: DataFrame, earlier: list[str]) -> DataFrame:
    """``_features``: the words and the probabilities of the categories before."""
    return VectorAssembler(inputCols=["_words", *[f"_p_{c}" for c in earlier]], outputCol="_features").transform(rows)


def learner(label: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="_features", labelCol=label, probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction", regParam=REGULARISATION, maxIter=40,
    )


def predict(model: LogisticRegressionModel, rows: DataFrame, out: str) -> DataFrame:
    scored = model.transform(rows)
    return scored.withColumn(out, vector_to_array("_probability")[1]).drop("_probability", "_raw", "_prediction")


def training_rows(
    docs: DataFrame, labels: DataFrame, categories=CATEGORIES, limit: int = TRAINING_DOCS,
) -> DataFrame:
    """At most ``limit`` labelled documents with their fold and terms; rows with an unknown label are left out."""
    given = labels.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), *[F.expr(sql).cast("double").alias(f"_y_{c}") for c, sql in categories]
    ).dropna()
    chosen = given.dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(limit)
    texts = docs.select(F.col("doc_id").alias("_id"), terms(text_of("text")).alias("_terms"))
    return texts.join(F.broadcast(chosen), "_id").withColumn("_fold", F.pmod(F.xxhash64("_id", F.lit("fold")), FOLDS))


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories=CATEGORIES, limit: int = TRAINING_DOCS,
) -> Chain | None:
    """Fit one linear model per category. Each is given the probabilities of the categories before it, which come
    from models fitted without the row's own fold; the models that are kept are fitted on all folds.

    The rows to fit on are bounded and written to the shared folder once. A category of which only one value occurs
    gets a model that always answers that value. Without any labelled document there is no chain.
    """
    split = materialize(training_rows(docs, labels, categories, limit), "toxicity")
    if split.isEmpty():
        return None
    vocabulary = telling_words(split, categories)
    rows = materialize(with_words(split, vocabulary), "toxicity")
    models, earlier = [], []
    for k, (category, _) in enumerate(categories):
        fitted = with_chain(rows, earlier)
        models.append((category, learner(f"_y_{category}").fit(fitted)))
        if k + 1 < len(categories):
            folds = [
                predict(
                    learner(f"_y_{category}").fit(fitted.filter(F.col("_fold") != f)),
                    fitted.filter(F.col("_fold") == f), f"_p_{category}",
                ) for f in range(FOLDS)
            ]
            together = folds[0]
            for part in folds[1:]:
                together = together.unionByName(part)
            rows = materialize(together.drop("_features"), "toxicity")
        earlier.append(category)
    return Chain(vocabulary, models)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with ``p_<category>`` for each category and ``is_toxic`` by the last one.

    No shuffle: every row is scored by itself, over its whole text. Null and empty texts have no words, so they get
    the models' base rates. Columns of ``docs`` come first; clashing ones are replaced.
    """
    rows = with_words(docs.withColumn("_terms", terms(text_of("text"))), chain.vocabulary)
    earlier: list[str] = []
    for category, model in chain.models:
        rows = predict(model, with_chain(rows, earlier), f"_p_{category}").drop("_features")
        earlier.append(category)
    named = rows.drop("_words").withColumns({f"p_{c}": F.col(f"_p_{c}") for c in earlier})
    return named.withColumn("is_toxic", F.col(f"_p_{earlier[-1]}") >= threshold).drop(*[f"_p_{c}" for c in earlier])


def detect(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit a chain on the labelled documents and score all. Without any usable label nothing is toxic."""
    chain = fit_chain(docs, labels)
    if chain is None:
        return docs.withColumns({**{f"p_{c}": F.lit(0.0) for c, _ in CATEGORIES}, "is_toxic": F.lit(False)})
    return score(docs, chain, threshold)
