"""CSV, JSON lines, model documents and zipped CSV archives."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZIP_MAGIC = b"PK\x03\x04"
CHUNK_ROWS = 10_000


def read_csv_strings(
    spark: SparkSession, path: str, columns: Sequence[str], line_breaks: bool = False
) -> DataFrame:
    """CSV with a header, every field as text: columns by their names in any order, null where the file lacks one.

    Quotes inside quoted fields are doubled, and quoted fields may hold line breaks. Files with line breaks are not
    split, so such a file is read by one task.
    """
    rows = spark.read.options(header=True, escape='"', multiLine=line_breaks).csv(path)
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_csv_inferred(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with types: from ``schema``, or inferred with one extra pass."""
    reader = spark.read.options(header=True, escape='"')
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_document(spark: SparkSession, doc: dict, path: str) -> None:
    """One JSON document as text, in a folder any executor can read."""
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    row = spark.read.option("wholetext", True).text(path).first()
    return json.loads(row[0])


def _csv_rows(content: bytes) -> Iterator[dict]:
    """Rows of the first CSV member of an archive, or of the text itself."""
    if content.startswith(ZIP_MAGIC):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = [n for n in archive.namelist() if n.lower().endswith(".csv")]
            if not names:
                raise ValueError("no CSV file in the archive")
            with archive.open(names[0]) as member:
                yield from csv.DictReader(io.TextIOWrapper(member, "utf-8", errors="ignore", newline=""))
        return
    text = content.decode("utf-8", errors="ignore")
    if "<html" in text.lower():
        raise ValueError("the content is HTML, not CSV")
    yield from csv.DictReader(io.StringIO(text, newline=""))


def expand_archives(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of CSV files or zip archives given as (path, content): (path, line, the columns as text).

    Every file is read by one task in chunks; a column a file lacks is null.
    """
    cols = list(columns)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk: list[tuple] = []

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(chunk, columns=["path", "line", *cols])
            chunk.clear()
            return out

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for line, row in enumerate(_csv_rows(bytes(content)), start=1):
                    chunk.append((path, line, *[row.get(c) for c in cols]))
                    if len(chunk) == CHUNK_ROWS:
                        yield flush()
        if chunk:
            yield flush()

    schema = "path string, line bigint, " + ", ".join(f"`{c}` string" for c in cols)
    return files.select("path", "content").mapInPandas(expand, schema)


def read_zip_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All archives of a folder."""
    return expand_archives(spark.read.format("binaryFile").load(path), columns)
