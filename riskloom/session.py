"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: list[str] = []
_STAGES: list[str] = []


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on: UTC, ANSI, AQE with skew handling, streaming state on disk."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and stage tables.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``. Only a local session (tests) without
    that setting uses a temporary folder of its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _FALLBACK:
            _FALLBACK.append(tempfile.mkdtemp(prefix="riskloom-"))
        base = _FALLBACK[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame that several passes read as a stage table, and return the table.

    The passes then read the stored columns and not the whole pipeline behind them, also after an executor was lost.
    """
    path = scratch_dir(df.sparkSession, purpose)
    _STAGES.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stages(spark: SparkSession) -> None:
    """Remove the stage tables that this driver has written so far: call it when the frames made from them are read up."""
    while _STAGES:
        remove(spark, _STAGES.pop())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextlib.contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """A stage table that is removed at the end, for frames that are read up by then."""
    path = scratch_dir(df.sparkSession, purpose)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
