"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-partitioned by id and sorted; each task sums the sizes of its
own rows. The totals of the tasks, one row each, give every task the bytes and
rows before it, so each row knows the bytes before it without any global sort
in one place. A shard ends where the running bytes pass an equal target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm.common import tasks, written


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
          carry: bool = False) -> DataFrame:
    """One row per input row: ``id``, ``size`` (UTF-8 bytes of the text and
    one), ``text_crc32``, ``shard``, ``slot`` and, with ``carry``, ``row`` (all
    input columns).

    Shards follow the order of ids (null first; rows that repeat an id by
    checksum and size). A row belongs to the shard that holds the middle of its
    bytes, so shard sizes differ from the target by at most one row's size.
    ``slot`` counts the rows of a shard from 0. A null text has no bytes.
    With fewer rows than shards some shards are empty, and an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    # the last key spreads rows that repeat an id over tasks
    order = ["id", "text_crc32", "size", "tie"]
    ranged = (rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(tasks(spark), *order)
              .sortWithinPartitions(*order).drop("tie"))

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, size, count = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            sizes = b.column("size").to_numpy()
            ends = size + np.cumsum(sizes)
            added = (np.full(len(sizes), task, np.int32), ends - sizes, count + np.arange(len(sizes)))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, added)],
                                             names=[*b.schema.names, "task", "before", "nth"])
            size, count = int(ends[-1]) if len(sizes) else size, count + len(sizes)

    numbered = T.StructType([*ranged.schema.fields, T.StructField("task", T.IntegerType()),
                             T.StructField("before", T.LongType()), T.StructField("nth", T.LongType())])
    placed = written(ranged.mapInArrow(running, numbered), "shard-rows")
    totals = placed.groupBy("task").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("task", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("first"),
                          F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first_row"))
    total = placed.agg(F.sum("size")).first()[0] or 1
    middle = 2 * (F.col("first") + F.col("before")) + F.col("size")
    # totals has one row for each task of the range shuffle
    cut = (placed.join(first, "task")
           .withColumn("shard", F.floor(middle * shards / F.lit(2 * total)).cast("int"))
           .withColumn("nth", F.col("first_row") + F.col("nth")))
    starts = cut.groupBy("shard").agg(F.min("nth").alias("start"))  # one row for each shard
    return (cut.join(F.broadcast(starts), "shard")
            .select("id", "size", "text_crc32", "shard", (F.col("nth") - F.col("start")).alias("slot"),
                    *(["row"] if carry else [])))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole rows as Parquet, a folder for each shard."""
    (shard(docs, shards, id_col, text_col, carry=True).select("row.*", F.col("shard").alias("_shard"))
     .write.partitionBy("_shard").parquet(path))
