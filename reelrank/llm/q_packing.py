"""Query of the packing operator. SQL has no tokenizer; the tests rebuild each
document from its pieces and compare with the tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.packing import pack


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens without padding."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id").select(
        "doc_id", "start", "length", F.col("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op2_packing": op2_packing}
ORACLE: dict[str, str] = {}
