"""Exact deduplication by content sort.

Rows are range-partitioned on the leading bytes of the text and its 64-bit
hash (Spark samples the splitters; a key is a few dozen bytes however long
the text is), sorted inside each partition by the whole text, and every row
is compared in full with its neighbours. Equal neighbours form a run.

A text with very many copies is cut: the range key ends with a salt made from
the row id, so the copies of one text lie in up to ``salts`` runs in different
tasks. Each run is summarised by one row, and the runs of a text meet through
its SHA-256, which is part of the result anyway: at most ``salts`` rows a text.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.llm.common import tasks, text_or_empty, written

HEAD_BYTES = 16


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
              salts: int | None = None, carry: bool = False) -> DataFrame:
    """One row per input row: ``id``, ``keep_id`` (the id that stays),
    ``group_size``, ``kept``, ``text_sha256``; with ``carry`` also ``row``,
    a struct of all input columns.

    ``keep`` is "min" or "max": the smallest or largest id of equal texts
    stays. A null text counts as empty. A null id loses against every other
    id; a group of null ids alone has a null ``keep_id``. When the row that
    stays is repeated (same id, same text) exactly one copy is ``kept``. An
    empty table gives an empty result. Other columns are never read by name.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    spark = docs.sparkSession
    salts = salts or max(64, 4 * tasks(spark))
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    rows = (rows.withColumn("head", F.substring(F.encode("text", "UTF-8"), 1, HEAD_BYTES))
                .withColumn("hash", F.xxhash64("text"))
                .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")))
    key = ["head", "hash", "salt"]
    # the row that stays comes first in its run
    first = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    in_order = Window.partitionBy(*key).orderBy(F.col("text"), first)
    before = F.lag("text").over(in_order)
    runs = (rows.repartitionByRange(tasks(spark), *key)
                .withColumn("starts", before.isNull() | (before != F.col("text")))
                .withColumn("run", F.sum(F.col("starts").cast("int")).over(
                    in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                .withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
                .drop("text"))
    runs = written(runs, "content-runs")
    best = F.min("id") if keep == "min" else F.max("id")
    per_run = runs.groupBy("sha", "hash", "salt", "run").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
    of_text = Window.partitionBy("sha")
    over = F.min("best").over(of_text) if keep == "min" else F.max("best").over(of_text)
    groups = per_run.select("sha", "hash", "salt", "run", over.alias("keep_id"),
                            F.sum("n").over(of_text).alias("group_size"))
    return (runs.join(groups, ["sha", "hash", "salt", "run"])
                .select("id", "keep_id", "group_size",
                        (F.col("starts") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"), *(["row"] if carry else [])))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                salts: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    return decisions(docs, id_col, text_col, keep, salts, carry=True).filter("kept").select("row.*")
