"""Seen sets, unseen filters and candidate generation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def seen_items(history: DataFrame, users: DataFrame, user: str = "userId",
               item: str = "movieId") -> DataFrame:
    """Distinct (user, item) pairs of ``history`` for users in ``users``.

    A left-semi join keeps the intent ("restrict to these users") without
    duplicating rows; the distinct is a hash aggregate with map-side combine.
    """
    return (history.select(user, item)
                   .join(users.select(user).distinct(), user, "left_semi")
                   .distinct())


def drop_seen_anti(scored: DataFrame, seen: DataFrame, user: str = "userId",
                   item: str = "movieId") -> DataFrame:
    """P7 canonical form: remove (user, item) pairs present in ``seen``.

    Both sides are keyed by (user, item); a hot user is spread over the item
    dimension of the hash key, so the join stays balanced.
    """
    return scored.join(seen.select(user, item), [user, item], "left_anti")


def drop_seen_array(scored: DataFrame, seen: DataFrame, user: str = "userId",
                    item: str = "movieId", chunk: int = 1000) -> DataFrame:
    """P7 in the reference's shape: seen sets, then ``seen IS NULL OR NOT
    array_contains(seen, item)``. A set holds the user's items of one range of
    ``chunk`` ids, so an array never grows with a history. Kept for parity;
    prefer :func:`drop_seen_anti`."""
    part = F.floor(F.col(item) / chunk).alias("_part")
    sets = seen.groupBy(user, part).agg(F.collect_set(item).alias("_seen"))
    return (scored.withColumn("_part", part).join(sets, [user, "_part"], "left")
                  .filter(F.col("_seen").isNull() | ~F.array_contains("_seen", F.col(item)))
                  .drop("_seen", "_part"))


def all_items(*frames: DataFrame, item: str = "movieId") -> DataFrame:
    """Union of item ids of several frames, distinct."""
    out = None
    for f in frames:
        part = f.select(item)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def unseen_candidates(requests: DataFrame, items: DataFrame, exclusions: DataFrame,
                      req: str = "request_id", item: str = "movieId", block: int = 4096) -> DataFrame:
    """Every catalogue item for every request, minus that request's
    exclusions. The result itself is requests x items; the scoring paths rank
    without it.

    The catalogue is cut into blocks of about ``block`` items; each request is
    sent to each block by number, along with its exclusions in that block (never
    more than the block holds), and meets the block's items in an equi-join. No
    side is broadcast, a task makes the pairs of a block, and a pair is in the
    result or dropped where it is made: pairs are never shuffled.
    """
    items = items.select(item).distinct()
    blocks = -(-items.count() // block) or 1                      # one scalar
    number = F.pmod(F.xxhash64(item), F.lit(blocks)).cast("int")
    cut = items.withColumn("_block", number)
    sent = (requests.select(req).distinct()
            .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    gone = (exclusions.select(req, F.col(item).cast(items.schema[item].dataType).alias(item))
            .join(items, item, "left_semi").groupBy(req, number.alias("_block")).agg(F.collect_set(item).alias("_gone")))
    excluded = F.coalesce(F.array_contains("_gone", F.col(item)), F.lit(False))
    return sent.join(gone, [req, "_block"], "left").join(cut, "_block").filter(~excluded).select(req, item)
