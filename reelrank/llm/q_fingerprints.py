"""Query of the document fingerprints. SQL has no form of the vectors; the
tests compare with a plain computation, paragraph by paragraph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.fingerprints import with_edits


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and that of its edited text."""
    return with_edits(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


QUERIES = {"op13_fingerprints": op13_fingerprints}
ORACLE: dict[str, str] = {}
