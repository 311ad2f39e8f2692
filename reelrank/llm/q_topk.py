"""Query of the exact top-k search and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.topk import top_k


def op1_topk_bitslices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every 50th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return (top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))


QUERIES = {"op1_topk_bitslices": op1_topk_bitslices}
ORACLE = {"op1_topk_bitslices": """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0
    )
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
    FROM scored
    QUALIFY rank <= 5"""}
