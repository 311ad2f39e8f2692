"""Ranked title search for a whole table of searches.

Titles are cut into trigrams (lower case, white space as one space, a space at
either end). The index has a posting for each title and trigram with its BM25
weight, and for each trigram and block of titles the largest weight. Blocks
hold titles that are neighbours in order of title, so a block's maxima say
much about what it can score.

All searches run in one job. The sum of a search's maxima bounds the scores of
a block; the best blocks are scored first, and their k-th score closes every
block whose bound is below it. What remains is scored in full, so the result
is that of scoring every title.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.functions.exprs import round6
from reelrank.operators.rank import top_k
from reelrank.session import ensure_checkpoint_dir

K1, B = 1.2, 0.75
BLOCK_TITLES = 4096
FIRST_BLOCKS = 2
SLACK = 2e-6   # scores are compared rounded to 6 decimals


@dataclass
class TitleIndex:
    """``postings`` (gram, block, item, weight) and ``maxima`` (gram, block, top)."""
    postings: DataFrame
    maxima: DataFrame


def _clean(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def trigrams(text: Column) -> Column:
    """The trigrams of a text, repeats included; none for an empty one."""
    padded = F.concat(F.lit(" "), _clean(text), F.lit(" "))
    # the array of characters is an argument of the outer lambda, so that it is made once a text
    chars = F.array(F.regexp_extract_all(padded, F.lit("(?s)."), F.lit(0)))
    found = F.transform(chars, lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2))))
    return F.when(F.length(padded) > 2, found[0]).otherwise(F.array().cast("array<string>"))


def build_index(items: DataFrame, item: str = "movieId", title: str = "title",
                block_titles: int = BLOCK_TITLES) -> TitleIndex:
    """The index of all titles. Null and empty titles have no postings and are
    never found; rows of equal title are titles each, an id that repeats is one
    title with all its rows' trigrams. The tables are checkpointed, since
    sampled block bounds could differ when computed again."""
    ensure_checkpoint_dir(items.sparkSession)
    rows = items.select(F.col(item).alias("item"), F.col(title).alias("title")).filter(F.col("item").isNotNull())
    one = rows.groupBy("item").agg(F.min("title").alias("first"), F.flatten(F.array_sort(F.collect_set(trigrams(F.col("title"))))).alias("grams"))
    blocks = -(-items.count() // block_titles) or 1
    dealt = (one.repartitionByRange(blocks, F.lower("first"), "item").withColumn("block", F.spark_partition_id())
             .filter(F.size("grams") > 0))
    counted = (dealt.select("item", "block", F.size("grams").alias("dl"), F.explode("grams").alias("gram"))
               .groupBy("item", "block", "dl", "gram").agg(F.count(F.lit(1)).alias("tf"))).checkpoint()
    n, mean = counted.select("item", "dl").distinct().agg(F.count(F.lit(1)), F.avg("dl")).first()   # two scalars
    df = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(mean or 1.0)))
    postings = counted.join(df, "gram").select("gram", "block", "item", weight.alias("weight")).checkpoint()
    return TitleIndex(postings, postings.groupBy("gram", "block").agg(F.max("weight").alias("top")))


def _open_blocks(index: TitleIndex, asked: DataFrame, k: int) -> DataFrame:
    """(search, block): the blocks that may hold one of a search's best ``k``."""
    bounds = (asked.join(index.maxima.hint("shuffle_merge"), "gram").groupBy("search", "block").agg(F.sum("top").alias("bound"))).checkpoint()
    first = top_k(bounds, FIRST_BLOCKS, "search", "bound", "block", "place").select("search", "block")
    best = top_k(_scores(index, asked, first), k, "search", "score", "item", "rank")
    floor = best.filter(F.col("rank") == k).select("search", F.col("score").alias("floor"))
    left = bounds.join(floor, "search", "left")
    return left.filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - SLACK)).select("search", "block")


def _scores(index: TitleIndex, asked: DataFrame, pairs: DataFrame) -> DataFrame:
    # merged: postings are many times the size Spark derives from the compressed titles, too many for a broadcast
    hits = asked.join(pairs, "search").join(index.postings.hint("shuffle_merge"), ["gram", "block"])
    return hits.groupBy("search", "item").agg(round6(F.sum("weight")).alias("score"))


def search(index: TitleIndex, searches: DataFrame, k: int = 10, min_chars: int = 2,
           search_id: str = "search", text: str = "text") -> DataFrame:
    """The ``k`` best titles of every search: (search, rank, item, score), by
    BM25 over shared trigrams rounded to 6 decimals, ties by id. A search that
    is null, shorter than ``min_chars`` or shares no trigram with any title has
    no rows; a trigram that repeats in a search counts once."""
    asked = (searches.select(F.col(search_id).alias("search"), F.col(text).alias("text"))
             .filter(F.length(_clean(F.col("text"))) >= min_chars)
             .select("search", F.explode(trigrams(F.col("text"))).alias("gram")).distinct()).checkpoint()
    return top_k(_scores(index, asked, _open_blocks(index, asked, k)), k, "search", "score", "item", "rank").select("search", "rank", "item", "score")
