"""Query of the line deduplication and its SQL, on the words themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.line_dedup import decisions


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, kept or with the earlier line it repeats.
    The edit bound is one word for lines of 8 words or more, one character for
    shorter lines, and none for lines of fewer than 8 characters."""
    return (decisions(table(spark, sf_dir, "documents"), min_chars=8)
            .select(F.col("id").alias("doc_id"), "line_no", "n_words", "kept",
                    F.col("keep_id").alias("keep_doc_id"), F.col("keep_line").alias("keep_line_no")))


SQL = """
    WITH split AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
    ),
    line AS (
        SELECT doc_id, (i - 1)::INTEGER AS line_no,
               list_filter(string_split_regex(parts[i], '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split)
    ),
    firsts AS (
        SELECT words, min({'d': doc_id, 'l': line_no}) AS pos FROM line WHERE len(words) > 0 GROUP BY words
    ),
    place AS (
        SELECT pos, words, unnest(range(0, len(words))) AS p FROM firsts WHERE len(words) >= 8
    ),
    variant AS (
        SELECT pos, p, list_concat(words[1:p], words[p + 2:]) AS v FROM place
    ),
    short AS (
        SELECT pos, array_to_string(words, ' ') AS s FROM firsts WHERE len(words) < 8 AND length(array_to_string(words, ' ')) >= 8
    ),
    short_variant AS (
        SELECT pos, p, left(s, p) || substr(s, p + 2) AS v
        FROM (SELECT pos, s, unnest(range(0, length(s))) AS p FROM short)
    ),
    near AS (
        SELECT pos, min(near) AS near FROM (
            SELECT pos, min(pos) OVER (PARTITION BY p, v) AS near FROM variant
            UNION ALL
            SELECT greatest(x.pos, f.pos), least(x.pos, f.pos) FROM variant x JOIN firsts f ON x.v = f.words AND len(f.words) >= 8
            UNION ALL
            SELECT pos, min(pos) OVER (PARTITION BY p, v) AS near FROM short_variant
            UNION ALL
            SELECT greatest(x.pos, f.pos), least(x.pos, f.pos) FROM short_variant x JOIN short f ON x.v = f.s
        ) GROUP BY pos
    )
    SELECT l.doc_id, l.line_no, len(l.words)::INTEGER AS n_words,
           f.pos IS NULL OR (f.pos.d = l.doc_id AND f.pos.l = l.line_no AND coalesce(n.near, f.pos) = f.pos) AS kept,
           CASE WHEN f.pos IS NULL THEN l.doc_id ELSE coalesce(n.near, f.pos).d END AS keep_doc_id,
           CASE WHEN f.pos IS NULL THEN l.line_no ELSE coalesce(n.near, f.pos).l END AS keep_line_no
    FROM line l LEFT JOIN firsts f ON l.words = f.words LEFT JOIN near n ON n.pos = f.pos"""

# the second name is what the rule for short lines was first registered under
QUERIES = {"op8_line_dedup": op8_line_dedup, "op8_line_dedup_short": op8_line_dedup}
ORACLE = dict.fromkeys(QUERIES, SQL)
