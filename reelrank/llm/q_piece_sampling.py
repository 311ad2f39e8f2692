"""Query of the piece sampler. SQL cannot sample lattices; the tests check
round trips, reproducibility and the distribution against enumerated paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.piece_sampling import round_trip


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sampled segmentation of every document, and whether it decodes to
    the very text."""
    both = round_trip(table(spark, sf_dir, "documents"), model_path())
    return both.select(F.col("id").alias("doc_id"), (F.octet_length("pieces") / 4).cast("long").alias("n_pieces"),
                       F.crc32("pieces").alias("ids_crc32"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
                       (F.col("decoded") == F.col("text")).alias("lossless"))


QUERIES = {"op6_piece_sampling": op6_piece_sampling}
ORACLE: dict[str, str] = {}
