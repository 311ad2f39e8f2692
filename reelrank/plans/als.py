"""Matrix-factorisation recommender on Spark ML ALS (M1-M5).

The model's top-n per user comes from blocked scoring
(``operators.block_topk``), which keeps n items a user inside each block
instead of materialising users x items.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.block_topk import block_top_k
from reelrank.operators.rank import top_k, top_n_per_user
from reelrank.session import ensure_checkpoint_dir

# The two ALS configurations to match (defaults and tuned).
DEFAULTS = dict(rank=10, max_iter=10, reg=0.1)     # library defaults, "before"
TUNED = dict(rank=20, max_iter=15, reg=0.1)        # "after"; fetch 50, keep 10
FETCH, KEEP = 50, 10
#: Iterations after which a fit writes its factors and lets go of the shuffle files before them.
CHECKPOINT = 2

_MODELS: dict[tuple, ALSModel] = {}


def fit_als(train: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
            seed: int = 0, user: str = "userId", item: str = "movieId",
            rating: str = "rating", cache_key: str | None = None) -> ALSModel:
    """M1: explicit-feedback ALS, nonnegative, cold-start rows dropped.

    ``cache_key`` shares one fitted model per session and input (fitting is
    the expensive step; scoring reuses it)."""
    key = None
    if cache_key is not None:
        key = (train.sparkSession.sparkContext.applicationId, cache_key, rank, max_iter, reg, seed)
        if key in _MODELS:
            return _MODELS[key]
    ensure_checkpoint_dir(train.sparkSession)  # ALS checkpoints its factor lineage
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, maxIter=max_iter,
              regParam=reg, coldStartStrategy="drop", nonnegative=True, seed=seed, checkpointInterval=CHECKPOINT)
    model = als.fit(train.select(user, item, rating))
    if key is not None:
        _MODELS[key] = model
    return model


def predict(model: ALSModel, df: DataFrame) -> DataFrame:
    """M2 scoring: a ``prediction`` column; unknown users/items dropped."""
    return model.transform(df)


def explode_recs(recs: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """array<struct<item, rating>> -> rows (user, rank, item, rating)."""
    return (recs.select(user, F.posexplode("recommendations").alias("_pos", "rec"))
                .select(user, (F.col("_pos") + 1).alias("rank"),
                        F.col(f"rec.{item}").alias(item), F.col("rec.rating").alias("rating")))


def recommend_subset(model: ALSModel, users: DataFrame, n: int, user: str = "userId") -> DataFrame:
    """M3: top-n for the given users, exploded."""
    return recommend_unseen(model, users, None, n, user)


def recommend_all(model: ALSModel, n: int) -> DataFrame:
    """M4: top-n for every known user, exploded."""
    return explode_recs(recommend_nested(model, n))


def recommend_nested(model: ALSModel, n: int, user: str = "userId", item: str = "movieId") -> DataFrame:
    """M4 as one row a user: (user, recommendations), an array of at most n
    (item, rating) in order of rank. Written to the checkpoint folder, so that
    readers of the lists do not score again."""
    ensure_checkpoint_dir(model.userFactors.sparkSession)
    rows = recommend_unseen(model, model.userFactors.select(F.col("id").alias(user)), None, n, user, item)
    lists = rows.groupBy(user).agg(F.array_sort(F.collect_list(F.struct("rank", item, "rating"))).alias("r"))
    return lists.select(user, F.transform("r", lambda r: F.struct(r[item].alias(item), r["rating"].alias("rating")))
                        .alias("recommendations")).checkpoint()


def item_lists(recs_nested: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """transform(recommendations, x -> x.item) as the predicted list."""
    return recs_nested.select(user, F.transform("recommendations", lambda x: x[item]).alias("pred_items"))


def overfetch(model: ALSModel, users: DataFrame, fetch: int = FETCH, keep: int = KEEP) -> DataFrame:
    """M5: fetch ``fetch`` per user, keep a zero-based index < ``keep`` per
    user (the user column is kept). Nothing is filtered in between; for unseen
    items use :func:`recommend_unseen`."""
    return top_n_per_user(recommend_subset(model, users, fetch), keep, score="rating")


def recommend_unseen(model: ALSModel, users: DataFrame, seen: DataFrame | None, k: int = 10,
                     user: str = "userId", item: str = "movieId", block: int | None = None,
                     user_factors: DataFrame | None = None) -> DataFrame:
    """Exact per-user top-k among items the user has not seen.

    User and item factors meet in blocks (``operators.block_topk``), together
    with the pairs that were seen, which are taken out before anything is
    ranked; k items a user leave a group. A user with a long history only adds
    its seen pairs, spread over the item blocks. Users or items the model does
    not know get no recommendations. ``seen`` may be None: then all items are
    ranked. ``user_factors`` (id, features) takes the place of the model's own.
    Returns (user, rank, item, rating).
    """
    user_factors = model.userFactors if user_factors is None else user_factors
    asked = user_factors.join(users.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
    gone = None if seen is None else seen.select(F.col(user).cast("int").alias("id"), F.col(item).cast("int").alias("item"))
    found = block_top_k(asked.select("id", F.col("features").alias("v")),
                        model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v")), k, gone, block)
    best = top_k(found, k, "id", "score", "item", "rank")
    return best.select(F.col("id").alias(user), "rank", F.col("item").alias(item), F.col("score").cast("float").alias("rating"))
