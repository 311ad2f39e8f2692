"""Query of the main-text extraction. SQL cannot parse pages; the tests use
pages of known content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.html_extract import extract


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return (table(spark, sf_dir, "pages").select("page_id", "url", extract(F.col("html")).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))


QUERIES = {"op9_html_extract": op9_html_extract}
ORACLE: dict[str, str] = {}
