"""All rows in the order of an id, so that each meets the row after it.

Rows are dealt to buckets by splitters taken from a sample of the ordering
keys, weighted by text length, and sorted within each. The first row of every
bucket is also sent to the bucket before it, as the last one's follower; the
first of all rows follows the last of all. So whole texts move once, and a task
reads one bucket front to back.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reelrank.llm.common import tasks

SAMPLED = 64  # keys a bucket
LOWEST = -(1 << 63)


def in_order(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with ``follower`` (boolean), in partitions sorted by id (null
    first) and, within one id, by a 64-bit hash of the text. In a partition
    every row's successor is the next row; a ``follower`` is there only as such.
    Rows equal in id and text are not told apart, so ``follower`` rows may be
    repeated: each after the first is to be skipped.

    Rows that share an id are split between tasks by their text's hash; copies
    of one row (same id, same text) stay in one task, which reads them in turn.
    """
    spark = rows.sparkSession
    n = tasks(spark)
    keyed = rows.withColumn("key", F.coalesce(F.col(id_col), F.lit(LOWEST))).withColumn("tie", F.xxhash64(text_col))
    total = keyed.count()
    wanted = SAMPLED * n
    sample = (keyed.select("key", "tie", (F.octet_length(text_col) + 64).alias("weight"))
              .sample(min(1.0, wanted / max(total, 1)), seed=1).orderBy("key", "tie").collect())
    weight = np.cumsum([r.weight for r in sample]) if sample else np.zeros(0)
    picks = sorted(set(np.searchsorted(weight, weight[-1] * np.arange(1, n) / n).tolist())) if sample else []
    cut_key = np.array([sample[i].key for i in picks], np.int64)
    cut_tie = np.array([sample[i].tie for i in picks], np.int64)

    def bucket_of(key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(cut_key, key, "left"), np.searchsorted(cut_key, key, "right")
        out = low.copy()
        split = np.flatnonzero(high > low)  # ids that hold a splitter
        if len(split):
            for k, where in pd.Series(split).groupby(key[split]):
                at = where.to_numpy()
                a, b = low[at[0]], high[at[0]]
                out[at] = a + np.searchsorted(cut_tie[a:b], tie[at], "right")
        return out

    @pandas_udf("int")
    def bucket(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(key.to_numpy(np.int64), tie.to_numpy(np.int64)))

    # one row a bucket
    heads = sorted(((r.bucket, r.head.key, r.head.tie) for r in
                    keyed.groupBy(bucket("key", "tie").alias("bucket")).agg(F.min(F.struct("key", "tie")).alias("head")).collect()))
    before = {h[1:]: heads[i - 1][0] for i, h in enumerate(heads)}
    head_key = np.array([h[1] for h in heads], np.int64)
    head_tie = np.array([h[2] for h in heads], np.int64)

    @pandas_udf("bucket int, also int")
    def places(key: pd.Series, tie: pd.Series) -> pd.DataFrame:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        mine = bucket_of(k, t)
        also = np.full(len(k), -1)
        for i in np.flatnonzero(np.isin(k, head_key) & np.isin(t, head_tie)).tolist():
            also[i] = before.get((int(k[i]), int(t[i])), -1)
        return pd.DataFrame({"bucket": mine, "also": also})

    own = F.struct(F.col("at.bucket").alias("bucket"), F.lit(False).alias("follower"))
    extra = F.struct(F.col("at.also").alias("bucket"), F.lit(True).alias("follower"))
    dealt = (keyed.withColumn("at", places("key", "tie"))
             .withColumn("at", F.explode(F.when(F.col("at.also") >= 0, F.array(own, extra)).otherwise(F.array(own))))
             .withColumn("bucket", F.col("at.bucket")).withColumn("follower", F.col("at.follower")).drop("at"))
    return (dealt.repartitionById(n, F.col("bucket"))
            .sortWithinPartitions("bucket", "follower", "key", "tie")
            .select(id_col, text_col, "follower"))
