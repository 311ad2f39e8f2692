"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the test tables through :class:`Frames`, so its work grows
with them. Arrays in outputs are rendered as comma-joined strings (sorted or
rank-ordered as stated) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.exprs import round6
from reelrank.operators import candidates as C
from reelrank.operators import metrics as M
from reelrank.operators import prep as P
from reelrank.operators import rank as R
from reelrank.plans.frames import Frames

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

K = 10


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def csv_ints(c) -> "F.Column":
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")


# ------------------------------------------------------------ scans, preps

@query("scan_ratings")
def scan_ratings(spark, sf_dir):
    """The derived ratings table with normalised types."""
    r = P.normalise_types(Frames(spark, sf_dir).ratings)
    return r.select("userId", "movieId", "rating",
                    F.date_format("ts", "yyyy-MM-dd").alias("day"), "split")


@query("positives")
def positives(spark, sf_dir):
    """Column list + rating >= 4 over the training split."""
    f = Frames(spark, sf_dir)
    return P.positives(f.train.select("userId", "movieId", "rating"), 4.0)


@query("labelled")
def labelled(spark, sf_dir):
    """Binary label on the training split."""
    f = Frames(spark, sf_dir)
    return P.with_label(f.train.select("userId", "movieId", "rating"), 4.0)


@query("train_val_union")
def train_val_union(spark, sf_dir):
    """Union all of the training and validation splits."""
    f = Frames(spark, sf_dir)
    a = f.train.select("userId", "movieId", "rating", F.lit("train").alias("split"))
    b = f.validation.select("userId", "movieId", "rating", F.lit("validation").alias("split"))
    return a.unionByName(b)


@query("all_items")
def all_items(spark, sf_dir):
    """Distinct items of train and test."""
    f = Frames(spark, sf_dir)
    return C.all_items(f.train, f.test)


@query("item_meta")
def item_meta(spark, sf_dir):
    """Distinct item metadata of the items in the training split, renamed."""
    return P.item_meta(Frames(spark, sf_dir).train_items())


@query("item_year")
def item_year(spark, sf_dir):
    """One year per training item (rows with a missing field dropped)."""
    return P.item_year(P.normalise_types(Frames(spark, sf_dir).train_items()))


@query("unseen_literal")
def unseen_literal(spark, sf_dir):
    """All items except a new visitor's literal history [1, 10, 50, 300]."""
    f = Frames(spark, sf_dir)
    return P.exclude_ids(C.all_items(f.train, f.test), [1, 10, 50, 300])


# ---------------------------------------------------- seen / unseen, top-k

def _seen(f: Frames) -> DataFrame:
    return C.seen_items(f.history().select("userId", "movieId"), f.test)


@query("seen_items")
def seen_items(spark, sf_dir):
    """Distinct (user, item) of train+validation for users in test."""
    return _seen(Frames(spark, sf_dir))


@query("drop_seen_anti")
def drop_seen_anti(spark, sf_dir):
    """P7 (anti-join form): scored test rows minus seen pairs."""
    f = Frames(spark, sf_dir)
    return C.drop_seen_anti(f.scored_test(), _seen(f)).select("userId", "movieId", "label", "score")


@query("drop_seen_array")
def drop_seen_array(spark, sf_dir):
    """P7 (reference array form): seen set per user + array_contains."""
    f = Frames(spark, sf_dir)
    return C.drop_seen_array(f.scored_test(), _seen(f)).select("userId", "movieId", "label", "score")


def _topk(f: Frames) -> DataFrame:
    return R.top_k(C.drop_seen_anti(f.scored_test(), _seen(f)), K)


@query("top_k")
def top_k(spark, sf_dir):
    """Per-user rank <= 10 by score desc, item asc, after the seen filter."""
    return _topk(Frames(spark, sf_dir)).select("userId", "rank", "movieId", "score", "label")


@query("topk_with_title")
def topk_with_title(spark, sf_dir):
    """Per-user unseen top-10 with titles (J2/J3); ``rank`` carries the order."""
    f = Frames(spark, sf_dir)
    titles = f.train_items().select("movieId", "title")
    return _topk(f).join(titles, "movieId", "left").select(
        "userId", "rank", "movieId", "title", F.col("score").alias("predicted_rating"))


@query("top_n_per_user")
def top_n_per_user(spark, sf_dir):
    """Zero-based per-user index < 10 over scored test rows (userId kept)."""
    f = Frames(spark, sf_dir)
    recs = f.scored_test().select("userId", "movieId", F.col("score").alias("rating"))
    return R.top_n_per_user(recs, K).select("userId", "index", "movieId", "rating")


@query("global_index")
def global_index(spark, sf_dir):
    """Zero-based index over the whole top-k frame by score desc."""
    f = Frames(spark, sf_dir)
    top = _topk(f).select("userId", "movieId", F.col("score").alias("rating"))
    return R.global_index(top).select("index", "userId", "movieId", "rating")


@query("top_overall")
def top_overall(spark, sf_dir):
    """The 10 best-scored items overall (ties by item id)."""
    return R.top_overall(Frames(spark, sf_dir).item_score, K, "score", "movieId")


# ------------------------------------------------------------- label family

def _outcomes(f: Frames) -> DataFrame:
    return M.label_outcomes(_topk(f), f.scored_test())


@query("label_precision")
def label_precision(spark, sf_dir):
    """Per-user hits, list size, precision@10."""
    return M.label_outcomes(_topk(Frames(spark, sf_dir))).select(
        "userId", "hits", "shown", round6("precision_at_k").alias("precision_at_k"))


@query("label_recall")
def label_recall(spark, sf_dir):
    """Per-user recall@10 against all scored test rows."""
    return _outcomes(Frames(spark, sf_dir)).select("userId", "hits", "relevant", round6("recall_at_k").alias("recall_at_k"))


@query("label_lists")
def label_lists(spark, sf_dir):
    """Labels per user in rank order."""
    return M.label_lists(_topk(Frames(spark, sf_dir))).select("userId", csv_ints("labels").alias("labels"))


@query("ndcg_at_k")
def ndcg_at_k(spark, sf_dir):
    """Per-user gain, best possible gain, nDCG@10 (NULL without positives)."""
    return M.label_outcomes(_topk(Frames(spark, sf_dir))).select(
        "userId", *[round6(c).alias(c) for c in ("gain", "best_gain", "ndcg_at_k")])


@query("mean_label_precision")
def mean_label_precision(spark, sf_dir):
    """Mean over users of avg(label) in the top-10."""
    return M.mean_label_precision(_topk(Frames(spark, sf_dir)))


@query("label_metrics")
def label_metrics(spark, sf_dir):
    """Precision, recall and nDCG@10 averaged over users."""
    f = Frames(spark, sf_dir)
    return M.label_metrics(_topk(f), f.scored_test(), K)


# --------------------------------------------------------------- set family

def _set_inputs(f: Frames):
    recs = R.top_k(f.scored_test(), K)            # seen items not removed (set family)
    truth = P.positives(f.test).select("userId", "movieId")
    return recs, truth


@query("pr_at_k")
def pr_at_k(spark, sf_dir):
    """Mean set precision@10 / recall@10 over users in both lists."""
    recs, truth = _set_inputs(Frames(spark, sf_dir))
    return M.set_precision_recall(recs, truth, K)


@query("pr_struct")
def pr_struct(spark, sf_dir):
    """Per-user struct(precision, recall), then star-expanded."""
    recs, truth = _set_inputs(Frames(spark, sf_dir))
    per = M.set_metrics_per_user(recs, truth)
    packed = per.select("userId", F.struct(round6("precision").alias("precision"),
                                           round6("recall").alias("recall")).alias("metrics"))
    return packed.select("userId", "metrics.*")


@query("rmse")
def rmse(spark, sf_dir):
    """M2 formula on given predictions: test ratings vs. the item's mean
    training rating; rows without a prediction are dropped (cold start drop)."""
    f = Frames(spark, sf_dir)
    pred = f.test.join(f.item_score.withColumnRenamed("score", "prediction"), "movieId")
    return M.rmse(pred)

