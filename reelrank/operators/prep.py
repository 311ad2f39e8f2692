"""Preparation operators: casts, labels, filters, renames, request parsing,
id encoding (section 2.2 of the survey)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.exprs import binary_label

def normalise_types(r: DataFrame) -> DataFrame:
    """movieId -> int; year -> int with try_cast (dirty strings become NULL)."""
    out = r
    if "movieId" in r.columns:
        out = out.withColumn("movieId", F.col("movieId").cast("int"))
    if "userId" in r.columns:
        out = out.withColumn("userId", F.col("userId").cast("int"))
    if "year" in r.columns:
        out = out.withColumn("year", F.expr("try_cast(year AS INT)"))
    return out


def with_label(r: DataFrame, threshold: float = 4.0, rating: str = "rating") -> DataFrame:
    """label = 1 when rating >= threshold, else 0."""
    return r.withColumn("label", binary_label(rating, threshold))


def positives(r: DataFrame, threshold: float = 4.0, rating: str = "rating") -> DataFrame:
    """Rows with rating >= threshold (pushed to the parquet scan when
    the rating column comes straight from a file)."""
    return r.filter(F.col(rating) >= threshold)


def item_meta(r: DataFrame) -> DataFrame:
    """Distinct item metadata with clash-free names."""
    return (r.select("movieId", "title", "genres").dropDuplicates()
             .withColumnRenamed("movieId", "movieId_meta")
             .withColumnRenamed("title", "title_meta")
             .withColumnRenamed("genres", "genres_meta"))


def item_year(r: DataFrame) -> DataFrame:
    """One year per item from rows with all fields present.

    ``dropDuplicates([movieId])`` keeps an arbitrary row; the smallest year
    is taken instead so the result is deterministic.
    """
    return (r.select("movieId", "year").dropna()
             .groupBy("movieId").agg(F.min("year").alias("year")))


def exclude_ids(df: DataFrame, ids: Sequence[int] | DataFrame, col: str = "movieId") -> DataFrame:
    """NOT IN a list or frame of ids, as a left-anti join: rows with a
    NULL id match nothing and stay, whatever the length of the list; NULLs in
    the list exclude nothing."""
    if not isinstance(ids, DataFrame):
        ids = df.sparkSession.createDataFrame([(int(i),) for i in ids if i is not None], f"{col} bigint")
    return df.join(ids.select(F.col(ids.columns[0]).alias(col)).distinct(), col, "left_anti")


def id_frame(spark: SparkSession, ids: Sequence[int], name: str = "userId") -> DataFrame:
    """A one-column frame of literal ids."""
    return spark.createDataFrame([(int(i),) for i in ids], f"{name} int")


def parse_histories(df: DataFrame, text_col: str, min_items: int = 2) -> DataFrame:
    """Validate comma-separated id lists.

    Adds ``history_ordered`` (first occurrence order, duplicates removed),
    ``history_sorted`` (ascending) and ``status``: ``ok``, ``bad_id`` when
    any non-blank token is not an integer, ``too_few`` when fewer than
    ``min_items`` distinct ids remain. Never raises.
    """
    tokens = F.filter(F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), ","),
                                  lambda t: F.trim(t)),
                      lambda t: t != "")
    as_int = F.transform(tokens, lambda t: t.try_cast("int"))
    has_bad = F.exists(as_int, lambda x: x.isNull())
    ordered = F.array_distinct(as_int)
    status = (F.when(has_bad, F.lit("bad_id"))
               .when(F.size(ordered) < min_items, F.lit("too_few"))
               .otherwise(F.lit("ok")))
    return (df.withColumn("status", status)
              .withColumn("history_ordered",
                          F.when(has_bad, F.array().cast("array<int>")).otherwise(ordered))
              .withColumn("history_sorted", F.array_sort("history_ordered")))


def encode_ids(r: DataFrame, item_map: DataFrame, user_map: DataFrame) -> DataFrame:
    """item_idx = encoder(movieId) + 1 with unknown -> 0; user_idx =
    encoder(userId) with unknown -> -1. Maps are (id, idx) frames."""
    im = item_map.select(F.col("id").alias("movieId"), F.col("idx").alias("_iidx"))
    um = user_map.select(F.col("id").alias("userId"), F.col("idx").alias("_uidx"))
    return (r.join(im, "movieId", "left").join(um, "userId", "left")
             .withColumn("item_idx", F.coalesce(F.col("_iidx"), F.lit(-1)) + 1)
             .withColumn("user_idx", F.coalesce(F.col("_uidx"), F.lit(-1)))
             .drop("_iidx", "_uidx"))
