"""The corpus pipeline: toxicity, exact copies, near copies, packing.

Each stage takes the documents that the one before kept, as reread from
Parquet. All but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences with their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import exact_dedup, minhash, packing, toxicity
from reelrank.llm.common import table, written
from reelrank.llm.q_packing import tokenizer_path
from reelrank.llm.q_toxicity import fitted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score under 0.5; empty and null texts are scored as
    any other. The classifier learns from the labels of the documents at hand,
    but for those held out."""
    model = fitted(docs, spark, sf_dir)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("row")).withColumn("score", toxicity.score(F.col("row.text"), model))
            .filter("score < 0.5").select("row.*"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; a null text is empty."""
    return exact_dedup.deduplicate(docs, keep="max")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingle sets that are 0.8 alike, the one
    with the smallest id; documents without words all stay."""
    return minhash.deduplicate(docs, words=5)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a sequence of its own."""
    return packing.pack(docs, tokenizer_path(), with_ids=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("packing", packed),
]

#: The first and last stage have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
