"""Query of the toxicity classifier. SQL cannot express the fit; the tests
measure held-out accuracy and the effect of the counterfactual penalty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import toxicity
from reelrank.llm.common import table


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from; a null id is not held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(5)) == 0, F.lit(False))


def fitted(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    score = toxicity.score(F.col("text"), fitted(docs, spark, sf_dir))
    return (docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLE: dict[str, str] = {}
