"""The corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import minhash, packing, quality, secrets, toxicity
from riskloom.registry import query
from riskloom.session import materialize
from riskloom.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram ratio."""
    judged = quality.assess(docs, table(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    judged = toxicity.detect(docs, table(spark, sf_dir, "labels"))
    return judged.filter(~F.col("is_toxic")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    found = minhash.deduplicate(docs)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redact(docs, materialize(secrets.scan(docs), "secrets"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", hide_secrets),
    ("packing", pack),
]

#: Models and token ids are beyond SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each one's rows are written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs


@query("pipeline", ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
