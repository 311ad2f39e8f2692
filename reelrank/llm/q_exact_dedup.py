"""Query of the exact deduplication and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.exact_dedup import decisions


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the equal text's largest doc_id, which stays."""
    return (decisions(table(spark, sf_dir, "documents"), keep="max")
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"))


QUERIES = {"op7_exact_dedup": op7_exact_dedup}
ORACLE = {"op7_exact_dedup": """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))"""}
