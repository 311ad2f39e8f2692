"""Ranking: per-group top-k, zero-based indexes, global top-k.

Every ranking breaks score ties on the item id so results are reproducible.
The per-group filter is always written as ``row_number <= k`` so Spark plans
a partial ``WindowGroupLimit`` before the shuffle: each map task forwards at
most k rows per group, which keeps a hot group cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(scored: DataFrame, k: int, group: str = "userId", score: str = "score",
          item: str = "movieId", rank_col: str = "rank") -> DataFrame:
    """1-based rank within ``group`` by score desc, item asc; keep rank <= k."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(item).asc())
    return scored.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_n_per_user(recs: DataFrame, n: int, group: str = "userId", score: str = "rating",
                   item: str = "movieId") -> DataFrame:
    """Zero-based ``index`` per user, keep index < n (userId kept)."""
    ranked = top_k(recs, n, group, score, item, rank_col="_rn")
    return ranked.withColumn("index", F.col("_rn") - 1).drop("_rn")


def global_index(recs: DataFrame, score: str = "rating", item: str = "movieId",
                 group: str = "userId") -> DataFrame:
    """Zero-based index over the whole frame by score desc (user, item
    break ties).

    A window without PARTITION BY would move every row into one task. The
    index is computed with the range-partitioned ordinal over one constant
    group instead, so the work stays spread over all partitions.
    """
    from reelrank.operators.ordinal import with_ordinal
    keyed = recs.withColumn("_all", F.lit(0))
    out = with_ordinal(keyed, "_all", [F.col(score).desc(), F.col(group).asc(), F.col(item).asc()],
                       pos_col="_pos", size_col="_n")
    return out.withColumn("index", F.col("_pos") - 1).drop("_all", "_pos", "_n")


def top_overall(df: DataFrame, k: int, score: str, *tie: str) -> DataFrame:
    """Global top-k as ORDER BY ... LIMIT k (TakeOrderedAndProject: each
    partition keeps k rows, the driver merges k x partitions)."""
    return df.orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tie]).limit(k)


def top_abs(df: DataFrame, k: int, value: str, *tie: str) -> DataFrame:
    """T5: top-k by absolute magnitude."""
    return df.orderBy(F.abs(F.col(value)).desc(), *[F.col(t).asc() for t in tie]).limit(k)


def top_k_excluding(lists: DataFrame, requests: DataFrame, exclusions: DataFrame, k: int,
                    group: str, req: str = "request_id", item: str = "movieId",
                    score: str = "score") -> DataFrame:
    """Per request, the k best items of its group's ranked list that are not
    in the request's exclusions (ties: item id).

    ``lists`` holds (group, item, score); ``requests`` holds (req, group);
    ``exclusions`` holds (req, item). The first k + |exclusions| items of a
    list always contain k allowed ones, so a request reads just the positions
    1 .. k + |exclusions| of its list, through a join on (group, position):
    the rows read are the exclusions plus k per request, whatever the other
    requests need. Returns (req, rank, item, score).
    """
    from reelrank.operators.ordinal import with_ordinal
    from reelrank.operators.sequences import explode_range
    ex_n = exclusions.groupBy(req).agg(F.count(F.lit(1)).alias("_ex"))
    need = (requests.select(req, group).distinct().join(ex_n, req, "left")
                    .select(req, group, (F.lit(k) + F.coalesce("_ex", F.lit(0))).cast("int").alias("_len")))
    order = with_ordinal(lists.select(group, item, score), group, [F.col(score).desc(), F.col(item).asc()],
                         pos_col="_pos", size_col="_size", materialize=True)
    reads = explode_range(need, "_len").withColumn("_pos", (F.col("t") + 1).cast("int"))
    cand = (reads.select(req, group, "_pos").join(order.select(group, "_pos", item, score), [group, "_pos"])
                 .join(exclusions.select(req, item), [req, item], "left_anti"))
    return top_k(cand, k, req, score, item).select(req, "rank", item, score)
