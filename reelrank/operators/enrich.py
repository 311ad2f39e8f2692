"""Id mapping and enrichment of recommendation lists.

The reference looks up one id per database connection and one detail record
per HTTP call. Here the lookups are joins of the whole recommendation frame
with the link and detail tables; the rank column carries the list order
through every join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prefix for poster paths; the path is appended only when it is non-empty.
IMAGE_BASE = "/images/w500"


def dedup_links(links: DataFrame, key: str, value: str) -> DataFrame:
    """One ``value`` per ``key``: the smallest (a lookup that repeats keys
    would otherwise return an arbitrary match)."""
    return links.groupBy(key).agg(F.min(value).alias(value))


def titles_for_ids(recs: DataFrame, items: DataFrame, item: str = "movieId") -> DataFrame:
    """S3: titles for recommended ids, keeping the rank column (an IN-list
    query would lose the order)."""
    return recs.join(items.select(item, "title"), item, "left")


def map_external(recs: DataFrame, links: DataFrame, item: str = "movieId",
                 ext: str = "tmdbId") -> DataFrame:
    """Item id -> external id; unmatched recommendations are dropped,
    rank order is kept."""
    return recs.join(dedup_links(links, item, ext), item)


def map_internal(ext_ids: DataFrame, links: DataFrame, item: str = "movieId",
                 ext: str = "tmdbId") -> DataFrame:
    """External id -> item id with ``status`` ok / not_found."""
    m = dedup_links(links, ext, item)
    return (ext_ids.join(m, ext, "left")
                   .withColumn("status", F.when(F.col(item).isNull(), "not_found").otherwise("ok")))


def enrich_recommendations(recs: DataFrame, links: DataFrame, details: DataFrame,
                           item: str = "movieId", image_base: str = IMAGE_BASE) -> DataFrame:
    """Recommendations with localised title, poster URL (NULL when
    the path is empty or missing) and release year; items without a link
    or detail record are dropped."""
    linked = map_external(recs, links, item)
    d = details.select(F.col("tmdb_id").alias("tmdbId"), "title_ko", "poster_path", "release_date")
    out = linked.join(d, "tmdbId")
    poster = F.when(F.length(F.coalesce("poster_path", F.lit(""))) > 0,
                    F.concat(F.lit(image_base), F.col("poster_path")))
    return (out.withColumn("poster_url", poster)
               .withColumn("release_year", F.substring("release_date", 1, 4)))


def enrich_input_items(history: DataFrame, links: DataFrame, details: DataFrame,
                       item: str = "movieId") -> DataFrame:
    """Every input item is kept; a missing external id or detail record
    yields a placeholder title and NULL poster."""
    linked = history.join(dedup_links(links, item, "tmdbId"), item, "left")
    d = details.select(F.col("tmdb_id").alias("tmdbId"), "title_ko", "poster_path")
    out = linked.join(d, "tmdbId", "left")
    title = (F.when(F.col("tmdbId").isNull(),
                    F.concat(F.lit("ID "), F.col(item).cast("string"), F.lit(" (no external id)")))
              .when(F.col("title_ko").isNull(),
                    F.concat(F.lit("ID "), F.col(item).cast("string"), F.lit(" (no details)")))
              .otherwise(F.col("title_ko")))
    poster = F.when(F.length(F.coalesce("poster_path", F.lit(""))) > 0,
                    F.concat(F.lit(IMAGE_BASE), F.col("poster_path")))
    return out.withColumn("display_title", title).withColumn("poster_url", poster)


def search_titles(items: DataFrame, text: str, limit: int = 10, min_chars: int = 2,
                  item: str = "movieId") -> DataFrame:
    """Case-insensitive title search, at most ``limit`` hits ordered by
    title then id; queries shorter than ``min_chars`` return nothing."""
    if len((text or "").strip()) < min_chars:
        return items.select(item, "title").limit(0)
    needle = text.strip().lower()
    hits = items.filter(F.contains(F.lower("title"), F.lit(needle)))
    return hits.select(item, "title").orderBy("title", item).limit(limit)
