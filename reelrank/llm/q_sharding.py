"""Query of the sharding operator and its SQL (CRC-32 worked out on the bytes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.sharding import shard

SHARDS = 16


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of nearly equal bytes."""
    return (shard(table(spark, sf_dir, "documents"), SHARDS)
            .select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


QUERIES = {"op5_sharding": op5_sharding}
ORACLE = {"op5_sharding": """
    WITH RECURSIVE shift(i, k, v) AS (
        SELECT i, 0, i::BIGINT FROM range(256) r(i)
        UNION ALL
        SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM shift WHERE k < 8
    ),
    crc_table AS (SELECT list(v ORDER BY i) AS t FROM shift WHERE k = 8),
    code AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h
        FROM documents
    ),
    bytes AS (
        SELECT doc_id, size, list_transform(range(0, size - 1), lambda i: (
            (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::BIGINT) AS b
        FROM code
    ),
    checked AS (
        SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
        FROM bytes, crc_table
    ),
    placed AS (
        SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before,
               sum(size) OVER () AS total,
               row_number() OVER (ORDER BY doc_id, text_crc32, size) AS nth
        FROM checked
    ),
    cut AS (SELECT *, ((2 * before + size) * 16 // (2 * total))::INTEGER AS shard FROM placed)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
           (row_number() OVER (PARTITION BY shard ORDER BY nth) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM cut"""}
