"""Ranking and rating metrics, three families kept apart (survey 2.12).

All per-user metrics are aggregations keyed by user (map-side partial
aggregation, so a hot user costs one partial row per task). Arrays appear
only for the top-k lists, whose length is bounded by k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.functions.exprs import ideal_dcg_of_ones, ideal_gain, ratio, round6


# ---------------------------------------------------------------- set family

def set_counts(recs: DataFrame, truth: DataFrame, user: str = "userId",
               item: str = "movieId") -> DataFrame:
    """Per user: distinct recommended items, distinct relevant items, hits.

    One union and two aggregations replace the reference's collect_set +
    array_intersect: (user, item) flags are merged first, then summed per
    user. Only users present in both inputs are kept (inner-join semantics).
    """
    r = recs.select(user, item, F.lit(1).alias("_r"), F.lit(0).alias("_t"))
    t = truth.select(user, item, F.lit(0).alias("_r"), F.lit(1).alias("_t"))
    pairs = (r.unionByName(t).groupBy(user, item)
              .agg(F.max("_r").alias("_r"), F.max("_t").alias("_t")))
    per = (pairs.groupBy(user)
                .agg(F.sum("_r").alias("n_rec"), F.sum("_t").alias("n_true"),
                     F.sum(F.col("_r") * F.col("_t")).alias("hits")))
    return per.filter((F.col("n_rec") > 0) & (F.col("n_true") > 0))


def set_metrics_per_user(recs: DataFrame, truth: DataFrame, user: str = "userId",
                         item: str = "movieId") -> DataFrame:
    """M13/D1 per user: precision = hits / |list|, recall = hits / |truth|."""
    c = set_counts(recs, truth, user, item)
    return c.select(user, "hits", "n_rec", "n_true",
                    F.coalesce(ratio("hits", "n_rec"), F.lit(0.0)).alias("precision"),
                    F.coalesce(ratio("hits", "n_true"), F.lit(0.0)).alias("recall"))


def set_precision_recall(recs: DataFrame, truth: DataFrame, k: int = 10,
                         user: str = "userId", item: str = "movieId") -> DataFrame:
    """One row with the mean precision@k and recall@k over users in both."""
    per = set_metrics_per_user(recs, truth, user, item)
    return per.agg(round6(F.avg("precision")).alias(f"avg_precision_at_{k}"),
                   round6(F.avg("recall")).alias(f"avg_recall_at_{k}"),
                   F.count(F.lit(1)).alias("users"))


# -------------------------------------------------------------- label family

def label_outcomes(ranked: DataFrame, scored: DataFrame | None = None, user: str = "userId", rank: str = "rank",
                   label: str = "label") -> DataFrame:
    """What each user's ranked list achieved, from one
    aggregation of sums (no list is built, so partial sums meet in the shuffle).

    ``hits`` of ``shown`` entries are positive; ``gain`` discounts every hit by
    its rank; ``best_gain`` is what as many hits at the top would gain. With
    ``scored`` also ``relevant``, the positives among *all* scored rows (before
    the seen filter), null for a user without any scored row. Ratios:
    ``precision_at_k``, ``recall_at_k``, ``ndcg_at_k``; null where there is
    nothing to divide by, so means leave them out."""
    won = F.col(label).cast("bigint")
    per = ranked.groupBy(user).agg(F.sum(won).alias("hits"), F.count(label).alias("shown"),
                                   F.sum(won / F.log2(F.col(rank) + 1)).alias("gain"))
    per = per.withColumn("best_gain", ideal_gain("hits"))
    per = (per.withColumn("precision_at_k", ratio("hits", "shown"))
              .withColumn("ndcg_at_k", ratio("gain", "best_gain")))
    if scored is None:
        return per
    per = per.join(scored.groupBy(user).agg(F.sum(won).alias("relevant")), user, "left")
    return per.withColumn("recall_at_k", ratio("hits", "relevant"))


def label_lists(ranked: DataFrame, user: str = "userId", rank: str = "rank", label: str = "label") -> DataFrame:
    """Labels per user in rank order. Sorting happens inside the array
    (sort-then-collect is not order-safe after a shuffle); length <= k."""
    entries = F.array_sort(F.collect_list(F.struct(rank, label)))
    return ranked.groupBy(user).agg(entries.getField(label).alias("labels"))


def label_metrics(ranked: DataFrame, scored: DataFrame, k: int = 10, user: str = "userId",
                  rank: str = "rank", label: str = "label") -> DataFrame:
    """One row with precision@k, recall@k and nDCG@k (label family), the
    means of ``label_outcomes``."""
    per = label_outcomes(ranked, scored, user, rank, label)
    return per.agg(*[round6(F.avg(f"{m}_at_k")).alias(f"{m}_at_{k}") for m in ("precision", "recall", "ndcg")])


def mean_label_precision(topk: DataFrame, user: str = "userId", label: str = "label") -> DataFrame:
    """Tuning objective = mean over users of avg(label) in the top-k;
    0.0 for an empty input."""
    per = topk.groupBy(user).agg(F.avg(label).alias("user_precision"))
    return per.agg(F.coalesce(round6(F.avg("user_precision")), F.lit(0.0)).alias("precision_at_k"))


# ------------------------------------------------------------ sampled family

def sampled_metrics_per_user(candidates: DataFrame, k: int = 10, user: str = "userId",
                             item: str = "movieId", score: str = "score",
                             truth_flag: str = "is_truth") -> DataFrame:
    """M16 per user on (user, item, score, is_truth) candidate rows: truth
    items plus sampled negatives. HIT, precision = hits / k (fixed), recall =
    hits / |truth|, nDCG = dcg / ideal dcg of k ones.

    A user's candidates are bounded by construction (truth + n negatives), so
    one rank window and one aggregation over the same user partitioning give
    every count."""
    w = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(item).asc())
    hit = F.col(truth_flag).cast("int") * (F.col("_rk") <= k).cast("int")
    ideal = ideal_dcg_of_ones(k)
    return (candidates.withColumn("_rk", F.row_number().over(w))
                      .groupBy(user)
                      .agg(F.sum(F.col(truth_flag).cast("int")).cast("bigint").alias("n_truth"),
                           F.sum(hit).cast("bigint").alias("hits"),
                           F.sum(hit / F.log2(F.col("_rk") + 1)).alias("dcg"))
                      .withColumn("hit", (F.col("hits") > 0).cast("int"))
                      .withColumn("precision", F.col("hits") / float(k))
                      .withColumn("recall", ratio("hits", "n_truth"))
                      .withColumn("ndcg", F.col("dcg") / ideal))


def sampled_metrics(candidates: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Means over all users with truth."""
    per = sampled_metrics_per_user(candidates, k, **kw)
    return per.agg(round6(F.avg("ndcg")).alias(f"ndcg_at_{k}"),
                   round6(F.avg("hit")).alias(f"hit_at_{k}"),
                   round6(F.avg("precision")).alias(f"precision_at_{k}"),
                   round6(F.avg("recall")).alias(f"recall_at_{k}"),
                   F.count(F.lit(1)).alias("users"))


# -------------------------------------------------------------------- rating

def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """M2 formula: sqrt(mean((label - prediction)^2)) over rows with a prediction."""
    p = predictions.filter(F.col(prediction).isNotNull() & ~F.isnan(prediction))
    return p.agg(round6(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))).alias("rmse"),
                 F.count(F.lit(1)).alias("n"))


def ranking_checks(recs: DataFrame, seen: DataFrame, user: str = "userId", item: str = "movieId",
                   score: str = "predicted_rating") -> DataFrame:
    """One row of counts over a ranked recommendation table (user, rank,
    item, score): users, rows, pairs that were seen, repeated pairs, rows
    whose rank is not their place in the user's list, and rows that score
    above the one before."""
    place = Window.partitionBy(user).orderBy("rank", item)
    marked = (recs.select(user, "rank", item, F.col(score).alias("_s"))
              .join(seen.select(user, item).distinct().withColumn("_seen", F.lit(1)), [user, item], "left")
              .withColumn("_place", F.row_number().over(place)).withColumn("_before", F.lag("_s").over(place)))
    pairs = marked.groupBy(user, item).agg(F.count(F.lit(1)).alias("_n"), F.sum((F.col("rank") != F.col("_place")).cast("int")).alias("_r"),
                                           F.sum(F.coalesce((F.col("_s") > F.col("_before")).cast("int"), F.lit(0))).alias("_o"),
                                           F.max(F.coalesce("_seen", F.lit(0))).alias("_seen"))
    return pairs.agg(F.count_distinct(user).alias("users"), F.sum("_n").alias("rows"),
                     F.sum("_seen").cast("bigint").alias("seen_pairs"), (F.sum("_n") - F.count(F.lit(1))).alias("repeated_pairs"),
                     F.sum("_r").alias("wrong_ranks"), F.sum("_o").alias("wrong_order"))
