"""Query of the run detection. SQL has no form of it; the tests compare with
all periods tried one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.periodic_runs import detect


def repeated(docs: DataFrame) -> DataFrame:
    """The texts whose runs are looked for: of every tenth document (by the
    hash of its id) the words from number a = g % n on are its p words from
    there over and over; all others as they are. A null id or text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(
        F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    rows = rows.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    again = "flatten(array_repeat(slice(words, a + 1, p), CAST(1 + (n - a) div p AS INT)))"
    made = f"array_join(concat(slice(words, 1, a), slice({again}, 1, n - a)), ' ')"
    return rows.select("doc_id", F.expr(f"CASE WHEN a IS NULL THEN text ELSE {made} END").alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of runs, its longest run, and digests of all
    runs and of its text without repeated periods."""
    docs = repeated(table(spark, sf_dir, "documents"))
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS l, r.start AS start, r.period AS period)))")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    return (detect(docs).withColumn("longest", longest)
            .select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
                    F.col("longest.start").alias("start"), (-F.col("longest.l")).alias("length"),
                    F.col("longest.period").alias("period"),
                    F.expr("-1000 * longest.l div longest.period").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE: dict[str, str] = {}
