"""Lazily built frames shared by the named queries of one (session, sf_dir)."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.exprs import round6
from reelrank.operators.prep import normalise_types, with_label
from reelrank.session import scratch_path
from reelrank.sources import tables as T


_SHARED: dict[tuple, DataFrame] = {}


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def key(self) -> tuple:
        """What shared tables and models are kept by: the application, the
        input folder and the state of its tables, so that a folder written
        again is read again."""
        state = T.state(self.spark, self.sf_dir)
        return (self.spark.sparkContext.applicationId, self.sf_dir, state)

    def shared(self, name: str, build, partition_by: str | None = None) -> DataFrame:
        """A derived table that several queries read, written once per session
        and state of the input as parquet in the session's shared checkpoint
        folder: later queries scan it, unused columns are not read, and a lost
        executor re-reads files instead of re-deriving them."""
        key = (*self.key, name)
        if key not in _SHARED:
            path = scratch_path(self.spark, f"{name}-{uuid.uuid4().hex}")
            writer = build().write.mode("overwrite")
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
            _SHARED[key] = self.spark.read.parquet(path)
        return _SHARED[key]

    # --- base tables -----------------------------------------------------
    @cached_property
    def ratings(self) -> DataFrame:
        """The derived ratings table, partitioned by split (a split filter
        prunes partitions)."""
        return self.shared("ratings", lambda: T.ratings(self.spark, self.sf_dir), "split")

    @cached_property
    def movies(self) -> DataFrame:
        return T.movies(self.spark, self.sf_dir)

    @cached_property
    def links(self) -> DataFrame:
        return T.links(self.spark, self.sf_dir)

    @cached_property
    def details(self) -> DataFrame:
        return T.details(self.spark, self.sf_dir)

    def split(self, name: str) -> DataFrame:
        return T.split(self.ratings, name)

    @property
    def train(self) -> DataFrame:
        return self.split("train")

    @property
    def validation(self) -> DataFrame:
        return self.split("validation")

    @property
    def test(self) -> DataFrame:
        return self.split("test")

    def history(self) -> DataFrame:
        """Train + validation rows in one scan (split IN (...))."""
        return self.ratings.filter(F.col("split").isin("train", "validation")).drop("split")

    # --- denormalised, labelled splits (the *_temp tables) ----------------
    def temp(self, name: str) -> DataFrame:
        return with_label(normalise_types(T.denormalised(self.split(name), self.movies)))

    def train_items(self) -> DataFrame:
        """Item rows (movieId, title, genres, year) of the items rated in the
        training split: the catalogue semi-joined to the distinct training
        item ids, rather than a distinct over every denormalised rating row
        (one metadata row per item, so the result is the same)."""
        return self.movies.join(self.train.select("movieId").distinct(), "movieId", "left_semi")

    # --- deterministic item score (stands in for a model score) ----------
    @cached_property
    def item_score(self) -> DataFrame:
        """movieId -> mean training rating rounded to 6 decimals."""
        return (self.train.groupBy("movieId")
                    .agg(round6(F.avg("rating")).alias("score")))

    def scored_test(self) -> DataFrame:
        """Test rows with label and the deterministic score (0.0 for items
        without training ratings)."""
        t = with_label(self.test)
        return (t.join(self.item_score, "movieId", "left")
                 .withColumn("score", F.coalesce(F.col("score"), F.lit(0.0))))
