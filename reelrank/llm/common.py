"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.session import ensure_checkpoint_dir, scratch_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Prepare the session for this subpackage's Python tasks: workers can
    import the library when the driver found it by path (a cluster ships it
    with --py-files or on PYTHONPATH), and batches of whole texts have 1,000
    rows, unless the session has chosen a number of its own."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet into the session's shared checkpoint
    folder and read it back: lineage is cut, and a lost executor costs a
    re-read instead of a re-computation."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def tasks(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
