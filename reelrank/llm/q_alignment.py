"""Query of the tokenizer alignment. SQL has no tokenizers; the tests compare
with a plain count over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.alignment import align
from reelrank.llm.common import table


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links under both tokenizers, scored
    by the document counts of the linked id pairs."""
    documents, _ = align(table(spark, sf_dir, "documents"), *tokenizer_paths())
    return documents.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {"op11_token_alignment": op11_token_alignment}
ORACLE: dict[str, str] = {}
