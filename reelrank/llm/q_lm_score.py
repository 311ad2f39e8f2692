"""Query of the language-model scores and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm.common import table
from reelrank.llm.lm_score import score


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram stupid-backoff score of every document by all others."""
    return (score(table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "n_words", F.round("score", 6).alias("score"), "backed_off"))


QUERIES = {"op3_lm_score": op3_lm_score}
ORACLE = {"op3_lm_score": """
    WITH doc AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
        FROM documents
    ),
    word AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
    gram AS (
        SELECT doc_id, i, len(w) AS n, k, array_to_string(w[i - k + 1:i], ' ') AS g
        FROM word, (SELECT unnest([1, 2, 3]) AS k) WHERE i >= k
    ),
    total AS (SELECT k, g, count(*) AS c FROM gram GROUP BY k, g),
    own AS (SELECT doc_id, k, g, count(*) AS c FROM gram GROUP BY doc_id, k, g),
    other AS (
        SELECT a.doc_id, a.i, a.n, a.k, t.c - o.c AS c
        FROM gram a JOIN total t ON a.k = t.k AND a.g = t.g JOIN own o ON a.doc_id = o.doc_id AND a.k = o.k AND a.g = o.g
    ),
    place AS (
        SELECT x.doc_id, x.i, x.n, x.c AS c1, y.c AS c2, z.c AS c3, p.c AS b1, q.c AS b2,
               (SELECT count(*) FROM word) - x.n AS rest
        FROM other x
        LEFT JOIN other y ON y.doc_id = x.doc_id AND y.i = x.i AND y.k = 2
        LEFT JOIN other z ON z.doc_id = x.doc_id AND z.i = x.i AND z.k = 3
        LEFT JOIN other p ON p.doc_id = x.doc_id AND p.i = x.i - 1 AND p.k = 1
        LEFT JOIN other q ON q.doc_id = x.doc_id AND q.i = x.i - 1 AND q.k = 2
        WHERE x.k = 1
    ),
    used AS (
        SELECT *, least(i, 3) AS longest,
               CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 ELSE 1 END AS k
        FROM place
    ),
    logs AS (
        SELECT doc_id, longest > k AS off, (longest - k) * ln(0.4) + CASE
            WHEN k = 3 THEN ln(c3::DOUBLE / b2) WHEN k = 2 THEN ln(c2::DOUBLE / b1)
            WHEN c1 > 0 THEN ln(c1::DOUBLE / rest) ELSE -ln(rest + 1.0) END AS s
        FROM used
    )
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, round(coalesce(sum(s), 0), 6) AS score,
           count(*) FILTER (WHERE off)::BIGINT AS backed_off
    FROM doc d LEFT JOIN logs l ON l.doc_id = d.doc_id
    GROUP BY d.doc_id, len(d.w)"""}
