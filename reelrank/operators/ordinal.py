"""Positions inside groups that stay balanced when one group is huge.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` puts every row of a key
into one task. When a single user holds a third of all rows that task holds a
third of the data. Here the rows are range-partitioned on ``(key, order...)``
instead: the range partitioner samples the full sort key, so a hot key is cut
into many contiguous slices. Each slice (partition id, key) is summarised by
its row count and first row id; a window over these summaries (at most one row
per partition for any key) gives every slice its offset, and a join on
``(partition id, key)`` -- never on the bare key -- hands the offsets back.

The tagged rows feed two branches (the summaries and the join). Range bounds
come from sampling, and a re-run can sample differently, so the tagged rows
are written once with a reliable ``checkpoint()`` into the session's shared
checkpoint folder. Both branches read that copy, and a lost executor re-reads
it instead of re-deriving partition ids that could differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import ensure_checkpoint_dir

def with_ordinal(df: DataFrame, key: str, order: Sequence[str | Column],
                 pos_col: str = "pos", size_col: str = "n",
                 num_partitions: int | None = None, materialize: bool = False) -> DataFrame:
    """Add ``pos_col`` (1-based position of the row inside ``key`` under
    ``order``) and ``size_col`` (rows in the group).

    ``order`` should make rows of a group distinct; ties get distinct
    consecutive positions in an unspecified order, as with ``row_number``.
    ``materialize`` checkpoints the result too, for outputs that feed several
    branches of a query (each branch then scans it instead of re-joining).
    """
    spark = df.sparkSession
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # Without an explicit count the range shuffle uses
    # spark.sql.shuffle.partitions and AQE may merge adjacent (still ordered)
    # ranges for small inputs; partition ids keep following the key order.
    ranged = (df.repartitionByRange(num_partitions, F.col(key), *order_cols)
              if num_partitions else df.repartitionByRange(F.col(key), *order_cols))
    ranged = (ranged
                .sortWithinPartitions(F.col(key), *order_cols)
                .withColumn("_rid", F.monotonically_increasing_id())
                .withColumn("_pid", F.spark_partition_id()))
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    slices = (ranged.groupBy("_pid", key)
                    .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_rid").alias("_first")))
    by_key = Window.partitionBy(key)
    slices = (slices
              .withColumn("_base", F.sum("_cnt").over(by_key.orderBy("_pid")) - F.col("_cnt"))
              .withColumn(size_col, F.sum("_cnt").over(by_key)))
    out = (ranged.join(slices, ["_pid", key])
                 .withColumn(pos_col, (F.col("_base") + F.col("_rid") - F.col("_first") + 1).cast("int"))
                 .withColumn(size_col, F.col(size_col).cast("int"))
                 .drop("_rid", "_pid", "_cnt", "_first", "_base"))
    return out.checkpoint(eager=True) if materialize else out
