"""Independent SQL for the named queries, run by DuckDB over the raw test
tables. Each statement restates the derivation of the rating and item tables
(FIXTURES.md) as common table expressions, then the query itself."""

from __future__ import annotations

BASE = """
WITH ratings AS (
  SELECT userId, movieId, rating, ts,
         CASE WHEN pos * 10 <= n * 8 THEN 'train'
              WHEN pos * 10 <= n * 9 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS pos,
               count(*) OVER (PARTITION BY userId) AS n
        FROM (SELECT CAST(o_custkey AS INT) AS userId, CAST(l_partkey AS INT) AS movieId,
                     CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS rating, l_shipdate AS ts,
                     row_number() OVER (PARTITION BY o_custkey, l_partkey
                       ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a
        WHERE rn = 1) b),
train AS (SELECT userId, movieId, rating, ts FROM ratings WHERE split = 'train'),
validation AS (SELECT userId, movieId, rating, ts FROM ratings WHERE split = 'validation'),
test AS (SELECT userId, movieId, rating, ts FROM ratings WHERE split = 'test'),
movies AS (
  SELECT CAST(p_partkey AS INT) AS movieId, concat(p_name, ' #', CAST(p_partkey AS VARCHAR)) AS title,
         concat(p_type, '|', split_part(p_name, ' ', 2)) AS genres, CAST(1970 + p_size AS VARCHAR) AS year
  FROM part),
links AS (
  SELECT CAST(p_partkey AS INT) AS movieId, CAST(p_partkey * 7 + 3 AS BIGINT) AS tmdbId
  FROM part WHERE p_size <> 13),
details AS (
  SELECT CAST(p_partkey * 7 + 3 AS BIGINT) AS tmdb_id, concat('ko-', p_name) AS title_ko,
         CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE concat('/', CAST(p_partkey AS VARCHAR), '.jpg') END AS poster_path,
         concat(CAST(1970 + p_size AS VARCHAR), '-01-01') AS release_date
  FROM part WHERE p_size NOT IN (13, 14)),
item_score AS (
  SELECT movieId, round(avg(rating), 6) AS score FROM train GROUP BY movieId),
scored_test AS (
  SELECT t.userId, t.movieId, t.rating, CASE WHEN t.rating >= 4 THEN 1 ELSE 0 END AS label,
         coalesce(s.score, 0.0) AS score
  FROM test t LEFT JOIN item_score s ON t.movieId = s.movieId),
seen AS (
  SELECT DISTINCT userId, movieId
  FROM (SELECT userId, movieId FROM train UNION ALL SELECT userId, movieId FROM validation) h
  WHERE userId IN (SELECT userId FROM test)),
topk AS (
  SELECT * FROM (
    SELECT s.*, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId ASC) AS rank
    FROM scored_test s
    WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.userId = s.userId AND x.movieId = s.movieId)) q
  WHERE rank <= 10)
"""


def sql(body: str) -> str:
    """Prefix the base CTEs. A body starting with WITH continues the list."""
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return BASE.rstrip() + ",\n" + body[5:]
    return BASE.rstrip() + "\n" + body


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = sql(body)


oracle("scan_ratings", """
SELECT userId, movieId, rating, strftime(ts, '%Y-%m-%d') AS day, split FROM ratings""")

oracle("positives", """
SELECT userId, movieId, rating FROM train WHERE rating >= 4""")

oracle("labelled", """
SELECT userId, movieId, rating, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label FROM train""")

oracle("train_val_union", """
SELECT userId, movieId, rating, 'train' AS split FROM train
UNION ALL
SELECT userId, movieId, rating, 'validation' AS split FROM validation""")

oracle("all_items", """
SELECT DISTINCT movieId FROM (SELECT movieId FROM train UNION ALL SELECT movieId FROM test) u""")

oracle("item_meta", """
SELECT DISTINCT t.movieId AS movieId_meta, m.title AS title_meta, m.genres AS genres_meta
FROM train t LEFT JOIN movies m ON t.movieId = m.movieId""")

oracle("item_year", """
SELECT t.movieId, min(TRY_CAST(m.year AS INT)) AS year
FROM train t LEFT JOIN movies m ON t.movieId = m.movieId
WHERE TRY_CAST(m.year AS INT) IS NOT NULL
GROUP BY t.movieId""")

oracle("unseen_literal", """
SELECT DISTINCT movieId FROM (SELECT movieId FROM train UNION ALL SELECT movieId FROM test) u
WHERE movieId NOT IN (1, 10, 50, 300)""")

oracle("seen_items", """SELECT userId, movieId FROM seen""")

oracle("drop_seen_anti", """
SELECT s.userId, s.movieId, s.label, s.score FROM scored_test s
WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.userId = s.userId AND x.movieId = s.movieId)""")

oracle("drop_seen_array", """
SELECT s.userId, s.movieId, s.label, s.score FROM scored_test s
WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.userId = s.userId AND x.movieId = s.movieId)""")

oracle("top_k", """SELECT userId, rank, movieId, score, label FROM topk""")

oracle("topk_with_title", """
SELECT k.userId, k.rank, k.movieId, m.title, k.score AS predicted_rating
FROM topk k LEFT JOIN (SELECT DISTINCT t.movieId, m.title FROM train t LEFT JOIN movies m
                       ON t.movieId = m.movieId) m ON k.movieId = m.movieId""")

oracle("top_n_per_user", """
SELECT userId, index, movieId, rating FROM (
  SELECT userId, movieId, score AS rating,
         row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) - 1 AS index
  FROM scored_test) q WHERE index < 10""")

oracle("global_index", """
SELECT row_number() OVER (ORDER BY score DESC, userId, movieId) - 1 AS index,
       userId, movieId, score AS rating
FROM topk""")

oracle("top_overall", """
SELECT movieId, score FROM item_score ORDER BY score DESC, movieId LIMIT 10""")

oracle("label_precision", """
SELECT userId, CAST(sum(label) AS BIGINT) AS hits, count(label) AS shown,
       round(sum(label) / count(label), 6) AS precision_at_k
FROM topk GROUP BY userId""")

oracle("label_recall", """
SELECT k.userId, k.hits, s.relevant, round(k.hits / NULLIF(s.relevant, 0), 6) AS recall_at_k
FROM (SELECT userId, CAST(sum(label) AS BIGINT) AS hits FROM topk GROUP BY userId) k
LEFT JOIN (SELECT userId, CAST(sum(label) AS BIGINT) AS relevant FROM scored_test GROUP BY userId) s
  ON k.userId = s.userId""")

oracle("label_lists", """
SELECT userId, string_agg(CAST(label AS VARCHAR), ',' ORDER BY rank) AS labels
FROM topk GROUP BY userId""")

_NDCG = """
WITH g AS (
  SELECT userId, sum(label / log2(rank + 1)) AS dcg FROM topk GROUP BY userId),
srt AS (
  SELECT userId, label, row_number() OVER (PARTITION BY userId ORDER BY label DESC, rank) AS r
  FROM topk),
ideal AS (SELECT userId, sum(label / log2(r + 1)) AS idcg FROM srt GROUP BY userId),
per AS (
  SELECT g.userId, g.dcg, i.idcg, g.dcg / NULLIF(i.idcg, 0) AS ndcg
  FROM g JOIN ideal i ON g.userId = i.userId)
"""

oracle("ndcg_at_k", _NDCG + """
SELECT userId, round(dcg, 6) AS gain, round(idcg, 6) AS best_gain, round(ndcg, 6) AS ndcg_at_k FROM per""")

oracle("mean_label_precision", """
SELECT coalesce(round(avg(p), 6), 0.0) AS precision_at_k
FROM (SELECT userId, avg(label) AS p FROM topk GROUP BY userId) q""")

oracle("label_metrics", _NDCG + """,
prec AS (SELECT userId, sum(label) / count(label) AS p FROM topk GROUP BY userId),
rec AS (
  SELECT tp.userId, tp.s / NULLIF(tot.s, 0) AS r
  FROM (SELECT userId, sum(label) AS s FROM topk GROUP BY userId) tp
  JOIN (SELECT userId, sum(label) AS s FROM scored_test GROUP BY userId) tot ON tp.userId = tot.userId)
SELECT round(avg(prec.p), 6) AS precision_at_10, round(avg(rec.r), 6) AS recall_at_10,
       round(avg(per.ndcg), 6) AS ndcg_at_10
FROM prec LEFT JOIN rec ON prec.userId = rec.userId LEFT JOIN per ON prec.userId = per.userId""")

_SET = """
WITH recs AS (
  SELECT userId, movieId FROM (
    SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rk
    FROM scored_test) q WHERE rk <= 10),
truth AS (SELECT DISTINCT userId, movieId FROM test WHERE rating >= 4),
per AS (
  SELECT r.userId, count(DISTINCT r.movieId) AS n_rec,
         (SELECT count(*) FROM truth t WHERE t.userId = r.userId) AS n_true,
         count(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM truth t WHERE t.userId = r.userId
                                          AND t.movieId = r.movieId) THEN r.movieId END) AS hits
  FROM recs r GROUP BY r.userId),
both_ AS (SELECT * FROM per WHERE n_true > 0)
"""

oracle("pr_at_k", _SET + """
SELECT round(avg(hits / n_rec), 6) AS avg_precision_at_10,
       round(avg(hits / n_true), 6) AS avg_recall_at_10, count(*) AS users
FROM both_""")

oracle("pr_struct", _SET + """
SELECT userId, round(hits / n_rec, 6) AS precision, round(hits / n_true, 6) AS recall FROM both_""")

oracle("rmse", """
SELECT round(sqrt(avg(power(t.rating - s.score, 2))), 6) AS rmse, count(*) AS n
FROM test t JOIN item_score s ON t.movieId = s.movieId""")


# ------------------------------------------------------------ sequences

from reelrank.functions.hashing import SCALE, hash52_sql  # noqa: E402

SEED = 42

_SEQ = """
WITH tpos AS (
  SELECT userId, movieId, rating, ts FROM train WHERE rating >= 4
  UNION ALL SELECT userId, movieId, rating, ts FROM validation WHERE rating >= 4),
active AS (
  SELECT * FROM tpos WHERE userId IN (SELECT userId FROM tpos GROUP BY userId HAVING count(*) >= 4)),
aseq AS (
  SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS pos,
         count(*) OVER (PARTITION BY userId) AS n FROM active),
imap AS (
  SELECT movieId, row_number() OVER (ORDER BY movieId) - 1 AS idx FROM (SELECT DISTINCT movieId FROM movies) m),
testpos AS (SELECT userId, movieId, rating, ts FROM test WHERE rating >= 4),
allpos AS (SELECT userId, movieId, rating, ts FROM ratings WHERE rating >= 4),
tactive AS (
  SELECT * FROM allpos WHERE userId IN (SELECT userId FROM allpos GROUP BY userId HAVING count(*) >= 13)),
hseq AS (
  SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS pos,
         count(*) OVER (PARTITION BY userId) AS n FROM tactive),
vocab AS (
  SELECT g, row_number() OVER (ORDER BY g) AS gi
  FROM (SELECT DISTINCT unnest(string_split(genres, '|')) AS g FROM movies) v),
gvec AS (
  SELECT m.movieId,
         string_agg(CAST(CASE WHEN list_contains(string_split(m.genres, '|'), v.g) THEN 1 ELSE 0 END AS VARCHAR),
                    ',' ORDER BY v.gi) AS genre_vec,
         string_agg(CAST(CASE WHEN contains(m.genres, v.g) THEN 1 ELSE 0 END AS VARCHAR),
                    ',' ORDER BY v.gi) AS genre_sub
  FROM movies m, vocab v GROUP BY m.movieId),
reqs AS (
  SELECT userId AS request_id, movieId,
         row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) AS pos,
         count(*) OVER (PARTITION BY userId) AS n FROM testpos),
trans AS (
  SELECT a.movieId AS prev_item, b.movieId AS next_item, count(*) AS transitions
  FROM aseq a JOIN aseq b ON a.userId = b.userId AND b.pos = a.pos + 1
  GROUP BY a.movieId, b.movieId)
"""


def seq_oracle(name: str, body: str) -> None:
    body = body.strip()
    if body[:5].upper() == "WITH ":
        oracle(name, _SEQ.rstrip() + ",\n" + body[5:])
    else:
        oracle(name, _SEQ.rstrip() + "\n" + body)


seq_oracle("min_activity_4", "SELECT userId, movieId, rating FROM active")
seq_oracle("min_activity_13", "SELECT userId, movieId, rating FROM tactive")
seq_oracle("vocab_sizes", """
SELECT (SELECT count(DISTINCT movieId) FROM movies) AS num_item,
       (SELECT count(DISTINCT userId) FROM active) AS num_user""")
seq_oracle("id_map", """
SELECT 'item' AS kind, movieId AS id, idx FROM imap
UNION ALL
SELECT 'user' AS kind, userId AS id, row_number() OVER (ORDER BY userId) - 1 AS idx
FROM (SELECT DISTINCT userId FROM active) u""")
# every table is used more than once, so each is made once; nothing else of the derivation is restated
ORACLE["encode_ids"] = BASE[:BASE.index("train AS (")].replace("ratings AS (", "ratings AS MATERIALIZED (") + """
kept AS MATERIALIZED (SELECT userId, movieId, split FROM ratings WHERE rating >= 4),
umap AS MATERIALIZED (
  SELECT userId, row_number() OVER (ORDER BY userId) - 1 AS uidx
  FROM (SELECT userId FROM kept WHERE split <> 'test' GROUP BY userId HAVING count(*) >= 4) u),
imap AS MATERIALIZED (
  SELECT movieId, row_number() OVER (ORDER BY movieId) - 1 AS idx
  FROM (SELECT DISTINCT CAST(p_partkey AS INT) AS movieId FROM part) m)
SELECT t.userId, t.movieId, CAST(coalesce(i.idx, -1) + 1 AS INT) AS item_idx, CAST(coalesce(u.uidx, -1) AS INT) AS user_idx
FROM (SELECT userId, movieId FROM kept WHERE split = 'test') t
LEFT JOIN imap i ON t.movieId = i.movieId LEFT JOIN umap u ON t.userId = u.userId"""
seq_oracle("user_sequences", "SELECT userId, pos, movieId FROM aseq")
seq_oracle("leave_one_out", "SELECT userId, n - 1 AS n_train, movieId AS valid_item FROM aseq WHERE pos = n")
seq_oracle("last_n_holdout", """
SELECT userId, max(n) - 10 AS n_input,
       string_agg(CAST(movieId AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos > n - 10) AS truth
FROM hseq GROUP BY userId""")
seq_oracle("pad_sequences", """
WITH w AS (
  SELECT a.userId, a.pos, i.idx + 1 AS tok FROM aseq a JOIN imap i ON a.movieId = i.movieId
  WHERE a.pos <= a.n - 1 AND a.pos > a.n - 1 - 80)
SELECT userId,
       repeat('0,', CAST(greatest(80 - count(*), 0) AS BIGINT))
         || string_agg(CAST(tok AS VARCHAR), ',' ORDER BY pos) AS seq
FROM w GROUP BY userId""")
seq_oracle("genre_multi_hot", "SELECT movieId, genre_vec FROM gvec")
seq_oracle("genre_sequences", """
WITH w AS (
  SELECT a.userId, a.pos, g.genre_vec FROM aseq a JOIN gvec g ON a.movieId = g.movieId
  WHERE a.pos <= a.n - 1 AND a.pos > a.n - 1 - 80),
z AS (SELECT string_agg('0', ',') AS zero FROM vocab)
SELECT userId,
       repeat(max(z.zero) || ';', CAST(greatest(80 - count(*), 0) AS BIGINT))
         || string_agg(genre_vec, ';' ORDER BY pos) AS genre_seq
FROM w, z GROUP BY userId""")
seq_oracle("genre_skew", """
SELECT v.g AS genre,
       CAST(sum(CASE WHEN list_contains(string_split(m.genres, '|'), v.g) THEN 1 ELSE 0 END) AS BIGINT) AS exact_items,
       CAST(sum(CASE WHEN contains(m.genres, v.g) THEN 1 ELSE 0 END) AS BIGINT) AS substring_items
FROM movies m, vocab v GROUP BY v.g""")
seq_oracle("genre_vocab", """
WITH toks AS (
  SELECT unnest(string_split(lower(m.genres), '|')) AS token
  FROM train t LEFT JOIN movies m ON t.movieId = m.movieId),
c AS (SELECT token, count(*) AS term_count FROM toks WHERE token <> '' GROUP BY token)
SELECT token, term_count, row_number() OVER (ORDER BY term_count DESC, token) - 1 AS term_index FROM c""")
seq_oracle("index_ids", """
WITH lab AS (
  SELECT CAST(userId AS VARCHAR) AS label, count(*) AS c FROM train GROUP BY 1),
idx AS (SELECT label, CAST(row_number() OVER (ORDER BY c DESC, label) - 1 AS DOUBLE) AS ix FROM lab)
SELECT u.userId, coalesce(i.ix, CAST((SELECT count(*) FROM lab) AS DOUBLE)) AS userIndex
FROM (SELECT DISTINCT userId FROM test) u LEFT JOIN idx i ON CAST(u.userId AS VARCHAR) = i.label""")

def sample_sql(name: str, need: str, rated: str, seed: int) -> str:
    """CTEs that draw from ``need`` (userId, n) catalogue items not in
    ``rated`` (userId, movieId); the last one is ``name`` (userId, movieId, draw)."""
    return f"""
{name}_rated AS (SELECT DISTINCT userId, movieId FROM {rated} WHERE movieId IN (SELECT movieId FROM imap)),
{name}_plan AS (
  SELECT d.userId, d.n, coalesce(r.c, 0) AS r, (SELECT count(*) FROM imap) AS I
  FROM {need} d LEFT JOIN (SELECT userId, count(*) AS c FROM {name}_rated GROUP BY userId) r ON d.userId = r.userId),
{name}_draws AS (
  SELECT userId, n, I, unnest(range(0, 4 * n + 64)) AS t FROM {name}_plan WHERE 2 * (n + r) < I),
{name}_cand AS (
  SELECT d.userId, d.n, i.movieId, min(d.t) AS o
  FROM {name}_draws d JOIN imap i ON i.idx = {hash52_sql(seed, 'draw', 'd.userId', 'd.t')} % d.I GROUP BY ALL
  UNION ALL
  SELECT p.userId, p.n, i.movieId, {hash52_sql(seed, 'item', 'p.userId', 'i.movieId')} AS o
  FROM {name}_plan p, imap i WHERE 2 * (p.n + p.r) >= p.I),
{name} AS (
  SELECT userId, movieId, draw FROM (
    SELECT c.*, row_number() OVER (PARTITION BY userId ORDER BY o, movieId) - 1 AS draw FROM {name}_cand c
    WHERE NOT EXISTS (SELECT 1 FROM {name}_rated r WHERE r.userId = c.userId AND r.movieId = c.movieId)) q
  WHERE draw < n)"""


_NEG = f"""
WITH husers AS (SELECT DISTINCT userId, 100 AS n FROM hseq),{sample_sql('neg', 'husers', 'hseq', SEED)}
"""

seq_oracle("negatives", _NEG + "SELECT userId, movieId, draw FROM neg")
seq_oracle("sampled_metrics", _NEG + """,
c AS (
  SELECT userId, movieId, 1 AS is_truth FROM hseq WHERE pos > n - 10
  UNION ALL SELECT userId, movieId, 0 AS is_truth FROM neg),
sc AS (
  SELECT c.*, coalesce(s.score, 0.0) AS score,
         row_number() OVER (PARTITION BY c.userId ORDER BY coalesce(s.score, 0.0) DESC, c.movieId) AS rk
  FROM c LEFT JOIN item_score s ON c.movieId = s.movieId),
per AS (
  SELECT userId, sum(is_truth) AS n_truth,
         sum(CASE WHEN rk <= 10 THEN is_truth ELSE 0 END) AS hits,
         sum(CASE WHEN rk <= 10 THEN is_truth / log2(rk + 1) ELSE 0 END) AS dcg
  FROM sc GROUP BY userId)
SELECT round(avg(dcg / 4.543559338088346), 6) AS ndcg_at_10,
       round(avg(CASE WHEN hits > 0 THEN 1 ELSE 0 END), 6) AS hit_at_10,
       round(avg(hits / 10.0), 6) AS precision_at_10,
       round(avg(hits / NULLIF(n_truth, 0)), 6) AS recall_at_10,
       count(*) AS users
FROM per""")

seq_oracle("serving_sequences", """
WITH z AS (SELECT string_agg('0', ',') AS zero FROM vocab),
known AS (
  SELECT r.request_id, r.pos, i.idx + 1 AS tok, g.genre_vec AS gv,
         row_number() OVER (PARTITION BY r.request_id ORDER BY r.pos DESC) AS back
  FROM reqs r JOIN imap i ON r.movieId = i.movieId JOIN gvec g ON r.movieId = g.movieId),
w AS (SELECT request_id, list(tok ORDER BY pos) AS toks, list(gv ORDER BY pos) AS gvs
      FROM known WHERE back <= 79 GROUP BY request_id),
allr AS (SELECT DISTINCT request_id FROM reqs),
full_ AS (
  SELECT a.request_id,
         list_append(coalesce(w.toks, []), CAST((SELECT count(*) FROM imap) + 1 AS INT)) AS t,
         list_append(coalesce(w.gvs, []), (SELECT zero FROM z)) AS g
  FROM allr a LEFT JOIN w ON a.request_id = w.request_id)
SELECT request_id,
       repeat('0,', CAST(greatest(80 - len(t), 0) AS BIGINT)) || array_to_string(t, ',') AS tokens,
       repeat((SELECT zero FROM z) || ';', CAST(greatest(80 - len(g), 0) AS BIGINT)) || array_to_string(g, ';') AS genre_seq
FROM full_""")

_MASK_H = hash52_sql(SEED, "mask", "s.userId", "s.pos")
seq_oracle("masked_sequences", f"""
WITH h AS (
  SELECT s.userId, s.pos, s.movieId, s.n, i.idx + 1 AS tok, {_MASK_H} / {SCALE} AS u
  FROM aseq s LEFT JOIN imap i ON s.movieId = i.movieId WHERE s.pos < s.n AND s.pos >= s.n - 80),
m AS (
  SELECT *, CASE WHEN u >= 0.15 THEN 'keep' WHEN u / 0.15 < 0.8 THEN 'mask'
                 WHEN u / 0.15 < 0.9 THEN 'random' ELSE 'keep' END AS action FROM h),
need AS (SELECT userId, count(*) AS n FROM m WHERE action = 'random' GROUP BY userId),{sample_sql('rnd', 'need', 'aseq', SEED + 7)},
slot AS (
  SELECT userId, pos, row_number() OVER (PARTITION BY userId ORDER BY pos) - 1 AS draw FROM m WHERE action = 'random'),
d AS (
  SELECT m.*, r.movieId AS rnd, i.idx + 1 AS rnd_tok
  FROM m LEFT JOIN slot s ON m.userId = s.userId AND m.pos = s.pos
  LEFT JOIN rnd r ON r.userId = s.userId AND r.draw = s.draw LEFT JOIN imap i ON i.movieId = r.movieId),
z AS (SELECT string_agg('0', ',') AS zero, string_agg('1', ',') AS ones FROM vocab),
e AS (
  SELECT d.userId, d.pos, d.tok AS label, CASE WHEN d.u < 0.15 THEN 1 ELSE 0 END AS chosen,
         CASE d.action WHEN 'mask' THEN (SELECT count(*) FROM imap) + 1 WHEN 'random' THEN d.rnd_tok ELSE d.tok END AS token,
         CASE WHEN d.action = 'mask' THEN z.ones ELSE coalesce(g.genre_vec, z.zero) END AS grow
  FROM d CROSS JOIN z LEFT JOIN gvec g ON g.movieId = CASE WHEN d.action = 'random' THEN d.rnd ELSE d.movieId END)
SELECT userId,
       repeat('0,', CAST(80 - count(*) AS BIGINT)) || string_agg(CAST(token AS VARCHAR), ',' ORDER BY pos) AS tokens,
       repeat('0,', CAST(80 - count(*) AS BIGINT)) || string_agg(CAST(label AS VARCHAR), ',' ORDER BY pos) AS labels,
       repeat('0,', CAST(80 - count(*) AS BIGINT)) || string_agg(CAST(chosen AS VARCHAR), ',' ORDER BY pos) AS is_masked,
       repeat((SELECT zero FROM z) || ';', CAST(80 - count(*) AS BIGINT)) || string_agg(grow, ';' ORDER BY pos) AS genre_seq
FROM e GROUP BY userId""")

seq_oracle("transitions", "SELECT prev_item, next_item, transitions FROM trans")
# ------------------------------------------------- requests, enrichment

_REQ = """,
cold AS (SELECT DISTINCT userId FROM ratings WHERE userId NOT IN (SELECT userId FROM active)),
creq AS (
  SELECT t.userId AS request_id, t.userId AS userId, t.movieId FROM test t
  UNION ALL
  SELECT -t.userId AS request_id, CAST(NULL AS INT) AS userId, t.movieId FROM test t),
anon AS (SELECT request_id, movieId FROM creq WHERE userId IS NULL),
coldanon AS (SELECT request_id, movieId FROM anon WHERE -request_id IN (SELECT userId FROM cold)),
ar AS (
  SELECT DISTINCT request_id, movieId FROM creq c
  WHERE c.userId IS NULL OR NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = c.userId)),
pp AS (SELECT DISTINCT userId, movieId FROM train),
rs AS (SELECT request_id, count(*) AS req_size FROM ar GROUP BY request_id),
ps AS (SELECT userId, count(*) AS user_size FROM pp GROUP BY userId),
inter AS (
  SELECT ar.request_id, pp.userId, count(*) AS inter FROM ar JOIN pp ON ar.movieId = pp.movieId GROUP BY 1, 2),
jsc AS (
  SELECT i.request_id, i.userId, i.inter, rs.req_size, ps.user_size,
         i.inter / (rs.req_size + ps.user_size - i.inter) AS jaccard
  FROM inter i JOIN rs ON i.request_id = rs.request_id JOIN ps ON i.userId = ps.userId),
nb AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY jaccard DESC, userId) AS rank
                 FROM jsc WHERE jaccard > 0) q WHERE rank <= 1),
given AS (SELECT DISTINCT request_id, movieId FROM reqs),
nsc AS (
  SELECT g.request_id, t.next_item AS movieId, CAST(sum(t.transitions) AS BIGINT) AS score
  FROM given g JOIN trans t ON g.movieId = t.prev_item
  WHERE NOT EXISTS (SELECT 1 FROM given x WHERE x.request_id = g.request_id AND x.movieId = t.next_item)
  GROUP BY 1, 2),
pop AS (
  SELECT i.movieId, coalesce(a.c, 0) AS c
  FROM imap i LEFT JOIN (SELECT movieId, count(*) AS c FROM active GROUP BY movieId) a ON i.movieId = a.movieId),
nxt AS (
  SELECT request_id, rank, movieId, score FROM (
    SELECT r.request_id, p.movieId, coalesce(s.score, 0) AS score,
           row_number() OVER (PARTITION BY r.request_id ORDER BY coalesce(s.score, 0) DESC, p.c DESC, p.movieId) AS rank
    FROM (SELECT DISTINCT request_id FROM reqs) r CROSS JOIN pop p
    LEFT JOIN nsc s ON s.request_id = r.request_id AND s.movieId = p.movieId
    WHERE NOT EXISTS (SELECT 1 FROM given x WHERE x.request_id = r.request_id AND x.movieId = p.movieId)) q
  WHERE rank <= 10),
lk AS (SELECT movieId, min(tmdbId) AS tmdbId FROM links GROUP BY movieId),
prof AS (
  SELECT userId, genre, m / NULLIF(nrm, 0) AS weight FROM (
    SELECT mean.userId, genre, m, sqrt(sum(m * m) OVER (PARTITION BY mean.userId)) AS nrm FROM (
      SELECT userId, genre, avg(rating) AS m FROM (
        SELECT t.userId, t.rating, unnest(string_split(mv.genres, '|')) AS genre
        FROM train t JOIN movies mv ON t.movieId = mv.movieId) g GROUP BY 1, 2) mean) z
  WHERE m / NULLIF(nrm, 0) IS NOT NULL)
"""


def req_oracle(name: str, body: str) -> None:
    body = body.strip()
    head = _SEQ.rstrip() + _REQ.rstrip()
    if body[:5].upper() == "WITH ":
        oracle(name, head + ",\n" + body[5:])
    else:
        oracle(name, head + "\n" + body)


req_oracle("next_items", "SELECT request_id, rank, movieId, score FROM nxt")

req_oracle("jaccard_neighbours", """
SELECT request_id, userId AS neighbour, inter, req_size, user_size, round(jaccard, 6) AS jaccard, rank FROM nb""")

req_oracle("known_user_flag", """
SELECT DISTINCT request_id,
       CASE WHEN userId IS NOT NULL AND userId IN (SELECT userId FROM train) THEN true ELSE false END AS known
FROM creq""")

req_oracle("request_exclusions", """
SELECT request_id, movieId FROM creq
UNION
SELECT c.request_id, t.movieId FROM (SELECT DISTINCT request_id, userId FROM creq WHERE userId IS NOT NULL) c
JOIN train t ON c.userId = t.userId
UNION
SELECT nb.request_id, t.movieId FROM nb JOIN train t ON nb.userId = t.userId""")

req_oracle("cold_start_candidates", """
WITH items AS (SELECT DISTINCT movieId FROM (SELECT movieId FROM train UNION ALL SELECT movieId FROM test) u)
SELECT nb.request_id, nb.userId AS neighbour, count(*) AS n_candidates
FROM nb, items i
WHERE nb.request_id IN (SELECT request_id FROM coldanon) AND NOT EXISTS (SELECT 1 FROM anon a WHERE a.request_id = nb.request_id AND a.movieId = i.movieId)
GROUP BY 1, 2""")

req_oracle("user_genre_profile", "SELECT userId, genre, round(weight, 6) AS weight FROM prof")

req_oracle("cosine_neighbours", """
WITH rp AS (
  SELECT userId, genre, m / NULLIF(nrm, 0) AS weight FROM (
    SELECT mean.userId, genre, m, sqrt(sum(m * m) OVER (PARTITION BY mean.userId)) AS nrm FROM (
      SELECT userId, genre, avg(rating) AS m FROM (
        SELECT t.userId, t.rating, unnest(string_split(mv.genres, '|')) AS genre
        FROM test t JOIN movies mv ON t.movieId = mv.movieId) g GROUP BY 1, 2) mean) z
  WHERE m / NULLIF(nrm, 0) IS NOT NULL),
dots AS (
  SELECT a.userId AS request_id, b.userId AS neighbour,
         round(sum(round(a.weight, 9) * round(b.weight, 9)), 12) AS cosine
  FROM rp a JOIN prof b ON a.genre = b.genre
  WHERE a.userId <> b.userId GROUP BY 1, 2)
SELECT request_id, neighbour, round(cosine, 6) AS cosine, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY cosine DESC, neighbour) AS rank FROM dots) q
WHERE rank <= 10""")

req_oracle("hybrid", """
WITH a AS (SELECT userId, movieId, round(score / 5.0, 9) AS s FROM scored_test),
b AS (SELECT request_id AS userId, movieId,
             round(score / max(score) OVER (PARTITION BY request_id), 9) AS s FROM nsc),
j AS (
  SELECT coalesce(a.userId, b.userId) AS userId, coalesce(a.movieId, b.movieId) AS movieId,
         0.5 * coalesce(a.s, 0.0) + 0.5 * coalesce(b.s, 0.0) AS score
  FROM a FULL OUTER JOIN b ON a.userId = b.userId AND a.movieId = b.movieId)
SELECT userId, rank, movieId, score FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rank FROM j) q
WHERE rank <= 10""")

req_oracle("titles_for_ids", """
SELECT n.request_id, n.rank, n.movieId, m.title FROM nxt n LEFT JOIN movies m ON n.movieId = m.movieId""")

req_oracle("map_external", """
SELECT n.request_id, n.rank, n.movieId, lk.tmdbId FROM nxt n JOIN lk ON n.movieId = lk.movieId""")

req_oracle("map_internal", """
WITH rl AS (SELECT tmdbId, min(movieId) AS movieId FROM links GROUP BY tmdbId)
SELECT d.tmdb_id AS tmdbId, rl.movieId, CASE WHEN rl.movieId IS NULL THEN 'not_found' ELSE 'ok' END AS status
FROM details d LEFT JOIN rl ON d.tmdb_id = rl.tmdbId""")

req_oracle("enrich_recommendations", """
SELECT n.request_id, n.rank, n.movieId, lk.tmdbId, d.title_ko,
       CASE WHEN length(coalesce(d.poster_path, '')) > 0 THEN '/images/w500' || d.poster_path END AS poster_url,
       substring(d.release_date, 1, 4) AS release_year
FROM nxt n JOIN lk ON n.movieId = lk.movieId JOIN details d ON d.tmdb_id = lk.tmdbId""")

req_oracle("enrich_input_items", """
SELECT c.request_id, c.movieId, lk.tmdbId,
       CASE WHEN lk.tmdbId IS NULL THEN 'ID ' || CAST(c.movieId AS VARCHAR) || ' (no external id)'
            WHEN d.title_ko IS NULL THEN 'ID ' || CAST(c.movieId AS VARCHAR) || ' (no details)'
            ELSE d.title_ko END AS display_title,
       CASE WHEN length(coalesce(d.poster_path, '')) > 0 THEN '/images/w500' || d.poster_path END AS poster_url
FROM creq c LEFT JOIN lk ON c.movieId = lk.movieId LEFT JOIN details d ON d.tmdb_id = lk.tmdbId""")

req_oracle("search_titles", """
SELECT movieId, title FROM movies WHERE contains(lower(title), 'red') ORDER BY title, movieId LIMIT 10""")

oracle("search_titles_ranked", """
WITH padded AS (
  SELECT movieId, title, ' ' || trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) || ' ' AS t FROM movies),
tf AS (
  SELECT movieId, gram, dl, count(*) AS tf
  FROM (SELECT movieId, length(t) - 2 AS dl, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS gram
        FROM padded) x GROUP BY movieId, gram, dl),
size AS (SELECT count(*) AS n, avg(length(t) - 2) AS mean FROM padded),
df AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram),
post AS (
  SELECT movieId, tf.gram, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean)) AS w
  FROM tf JOIN df ON tf.gram = df.gram CROSS JOIN size),
asked AS (
  SELECT DISTINCT text, unnest(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3))) AS gram
  FROM (SELECT DISTINCT p_name AS text, ' ' || lower(p_name) || ' ' AS p FROM part) y)
SELECT text, rank, s.movieId, m.title, score
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY score DESC, movieId) AS rank
      FROM (SELECT text, movieId, round(sum(w), 6) AS score
            FROM asked JOIN post ON asked.gram = post.gram GROUP BY text, movieId) a) s
JOIN movies m ON s.movieId = m.movieId WHERE rank <= 10""")

oracle("parse_histories", """
WITH b AS (
  SELECT l_orderkey AS request_id, CAST((l_linenumber - 1) // 1000 AS INTEGER) AS chunk,
         CAST(l_partkey AS INT) AS pk, min(l_linenumber) AS first_ln
  FROM lineitem GROUP BY 1, 2, 3)
SELECT request_id, chunk, CASE WHEN count(*) < 2 THEN 'too_few' ELSE 'ok' END AS status,
       string_agg(CAST(pk AS VARCHAR), ',' ORDER BY pk) AS history_sorted,
       string_agg(CAST(pk AS VARCHAR), ',' ORDER BY first_ln, pk) AS history_ordered
FROM b GROUP BY request_id, chunk""")


req_oracle("recommend_requests_mean", """
WITH ex AS (
  SELECT request_id, movieId FROM creq
  UNION SELECT c.request_id, t.movieId
  FROM (SELECT DISTINCT request_id, userId FROM creq WHERE userId IS NOT NULL) c JOIN train t ON c.userId = t.userId
  UNION SELECT nb.request_id, t.movieId FROM nb JOIN train t ON nb.userId = t.userId)
SELECT request_id, rank, movieId, title, score FROM (
  SELECT r.request_id, i.movieId, m.title, i.score,
         row_number() OVER (PARTITION BY r.request_id ORDER BY i.score DESC, i.movieId) AS rank
  FROM (SELECT DISTINCT request_id FROM creq) r CROSS JOIN item_score i JOIN movies m ON i.movieId = m.movieId
  WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.request_id = r.request_id AND ex.movieId = i.movieId)) q
WHERE rank <= 10""")


# ------------------------------------------------------------ models

oracle("features", """
WITH u AS (
  SELECT userId, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(userId AS VARCHAR)) - 1 AS DOUBLE) AS ix
  FROM train GROUP BY userId),
m AS (
  SELECT movieId, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(movieId AS VARCHAR)) - 1 AS DOUBLE) AS ix
  FROM train GROUP BY movieId),
v AS (
  SELECT DISTINCT unnest(string_split(lower(mv.genres), '|')) AS token
  FROM train t JOIN movies mv ON t.movieId = mv.movieId)
SELECT t.userId, t.movieId, CASE WHEN t.rating >= 4 THEN 1 ELSE 0 END AS label, u.ix AS userIndex, m.ix AS movieIndex,
       coalesce(TRY_CAST(mv.year AS INT), 0) AS year,
       CAST((SELECT count(*) FROM v WHERE token <> '') + 4 AS INT) AS n_features
FROM train t JOIN u ON t.userId = u.userId JOIN m ON t.movieId = m.movieId LEFT JOIN movies mv ON t.movieId = mv.movieId""")

oracle("model_roundtrip", "SELECT count(*) AS rows, CAST(0.0 AS DOUBLE) AS max_abs_diff FROM test")

_UNSEEN = """
WITH cat AS (SELECT DISTINCT movieId FROM train),
usr AS (SELECT DISTINCT userId FROM test WHERE userId IN (SELECT userId FROM train)),
hist AS (SELECT DISTINCT userId, movieId FROM seen WHERE movieId IN (SELECT movieId FROM cat)),
want AS (
  SELECT usr.userId, least(10, (SELECT count(*) FROM cat) - coalesce(h.c, 0)) AS n
  FROM usr LEFT JOIN (SELECT userId, count(*) AS c FROM hist GROUP BY userId) h ON usr.userId = h.userId)
"""
oracle("als_topk_checks", _UNSEEN + """
SELECT count(*) FILTER (WHERE n > 0) AS users, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS seen_pairs,
       CAST(0 AS BIGINT) AS repeated_pairs, CAST(0 AS BIGINT) AS wrong_ranks, CAST(0 AS BIGINT) AS wrong_order
FROM want""")

oracle("als_foldin_checks", """
WITH cat AS (SELECT DISTINCT movieId FROM train),
want AS (
  SELECT userId, least(10, (SELECT count(*) FROM cat) - count(DISTINCT movieId)) AS n
  FROM test WHERE movieId IN (SELECT movieId FROM cat) GROUP BY userId)
SELECT count(*) FILTER (WHERE n > 0) AS users, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS seen_pairs,
       CAST(0 AS BIGINT) AS repeated_pairs, CAST(0 AS BIGINT) AS wrong_ranks, CAST(0 AS BIGINT) AS wrong_order
FROM want""")

oracle("als_foldin_known", "SELECT count(DISTINCT userId) AS users, CAST(0 AS BIGINT) AS differing FROM train")

oracle("explain_row_checks", """
SELECT count(DISTINCT s.userId) AS users, CAST(0 AS BIGINT) AS incomplete, CAST(0 AS BIGINT) AS not_additive
FROM test s WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.userId = s.userId AND x.movieId = s.movieId)""")

oracle("gbt_topk_checks", """
WITH cand AS (
  SELECT s.userId, s.movieId FROM test s
  WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.userId = s.userId AND x.movieId = s.movieId)),
want AS (SELECT userId, least(count(*), 10) AS n FROM cand GROUP BY userId)
SELECT count(*) AS users, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS seen_pairs,
       CAST(0 AS BIGINT) AS repeated_pairs, CAST(0 AS BIGINT) AS wrong_ranks, CAST(0 AS BIGINT) AS wrong_order
FROM want""")


# ------------------------------------------------------------ file round trips

oracle("csv_roundtrip", "SELECT movieId, title, genres, year FROM movies")

oracle("json_roundtrip", """
SELECT CAST(k.userId AS INT) AS userIndex, m.title, k.score AS predicted_rating
FROM topk k LEFT JOIN (SELECT DISTINCT t.movieId, m.title FROM train t LEFT JOIN movies m
                       ON t.movieId = m.movieId) m ON k.movieId = m.movieId""")

seq_oracle("id_map_roundtrip", """
SELECT 'item' AS kind, movieId AS id, idx FROM imap
UNION ALL
SELECT 'user' AS kind, userId AS id, row_number() OVER (ORDER BY userId) - 1 AS idx
FROM (SELECT DISTINCT userId FROM active) u""")

oracle("run_log", _NDCG + """,
prec AS (SELECT userId, sum(label) / count(label) AS p FROM topk GROUP BY userId),
rec AS (
  SELECT tp.userId, tp.s / NULLIF(tot.s, 0) AS r
  FROM (SELECT userId, sum(label) AS s FROM topk GROUP BY userId) tp
  JOIN (SELECT userId, sum(label) AS s FROM scored_test GROUP BY userId) tot ON tp.userId = tot.userId),
m AS (
  SELECT round(avg(prec.p), 6) AS p, round(avg(rec.r), 6) AS r, round(avg(per.ndcg), 6) AS n
  FROM prec LEFT JOIN rec ON prec.userId = rec.userId LEFT JOIN per ON prec.userId = per.userId)
SELECT 'label-ranking' AS run, 'param' AS kind, 'k' AS name, 10.0 AS value
UNION ALL SELECT 'label-ranking', 'param', 'threshold', 4.0
UNION ALL SELECT 'label-ranking', 'metric', 'precision_at_10', p FROM m
UNION ALL SELECT 'label-ranking', 'metric', 'recall_at_10', r FROM m
UNION ALL SELECT 'label-ranking', 'metric', 'ndcg_at_10', n FROM m""")

req_oracle("unseen_candidates", """
WITH items AS (SELECT DISTINCT movieId FROM (SELECT movieId FROM train UNION ALL SELECT movieId FROM test) u)
SELECT r.request_id, i.movieId FROM (SELECT DISTINCT request_id FROM anon) r, items i
WHERE NOT EXISTS (SELECT 1 FROM anon a WHERE a.request_id = r.request_id AND a.movieId = i.movieId)""")

oracle("item_sets", """
SELECT userId, chunk, count(*) AS n_items, string_agg(CAST(movieId AS VARCHAR), ',' ORDER BY movieId) AS items
FROM (SELECT *, (row_number() OVER (PARTITION BY userId ORDER BY movieId) - 1) // 1000 AS chunk
      FROM (SELECT DISTINCT userId, movieId FROM train) d) p GROUP BY userId, chunk""")

seq_oracle("encode_history", """
WITH v AS (SELECT movieId, row_number() OVER (ORDER BY movieId) AS tok FROM (SELECT DISTINCT movieId FROM train) t)
SELECT r.request_id, r.pos, r.movieId, v.tok FROM reqs r JOIN v ON r.movieId = v.movieId""")


# ------------------------------------------------------------ column types
# Spark numbers rows, positions and ranks with 32-bit ints where DuckDB's
# row_number() gives BIGINT; these columns are cast so both schemas agree.
INT_COLUMNS = {
    "cosine_neighbours": ["rank"], "encode_history": ["pos", "tok"],
    "encode_ids": ["item_idx", "user_idx"], "enrich_recommendations": ["rank"],
    "genre_vocab": ["term_index"], "global_index": ["index"], "hybrid": ["rank"],
    "id_map": ["idx"], "id_map_roundtrip": ["idx"], "item_sets": ["n_items", "chunk"],
    "jaccard_neighbours": ["rank"], "recommend_requests_mean": ["rank"], "leave_one_out": ["n_train"], "map_external": ["rank"],
    "negatives": ["draw"], "next_items": ["rank"], "titles_for_ids": ["rank"], "top_k": ["rank"],
    "top_n_per_user": ["index"], "topk_with_title": ["rank"], "user_sequences": ["pos"],
}

for _key, _cols in INT_COLUMNS.items():
    _casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in _cols)
    ORACLE[_key] = f"SELECT * REPLACE ({_casts}) FROM (\n{ORACLE[_key]}\n) AS typed"

seq_oracle("next_item_sampled_metrics", _NEG + """,
c AS (
  SELECT userId, movieId, 1 AS is_truth FROM hseq WHERE pos > n - 10
  UNION ALL SELECT userId, movieId, 0 AS is_truth FROM neg),
li AS (SELECT userId, movieId AS prev_item FROM hseq WHERE pos = n - 10),
learn AS (
  SELECT a.userId, a.movieId,
         row_number() OVER (PARTITION BY a.userId ORDER BY a.ts, a.movieId) AS pos
  FROM allpos a
  WHERE NOT EXISTS (SELECT 1 FROM hseq h WHERE h.pos > h.n - 10
                    AND h.userId = a.userId AND h.movieId = a.movieId)),
ltrans AS (
  SELECT x.movieId AS prev_item, y.movieId AS next_item, count(*) AS transitions
  FROM learn x JOIN learn y ON x.userId = y.userId AND y.pos = x.pos + 1
  GROUP BY x.movieId, y.movieId),
sc AS (
  SELECT c.*, coalesce(CAST(t.transitions AS DOUBLE), 0.0) AS score
  FROM c LEFT JOIN li ON c.userId = li.userId
         LEFT JOIN ltrans t ON t.prev_item = li.prev_item AND t.next_item = c.movieId),
rk AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS r FROM sc),
per AS (
  SELECT userId, sum(is_truth) AS n_truth,
         sum(CASE WHEN r <= 10 THEN is_truth ELSE 0 END) AS hits,
         sum(CASE WHEN r <= 10 THEN is_truth / log2(r + 1) ELSE 0 END) AS dcg
  FROM rk GROUP BY userId)
SELECT round(avg(dcg / 4.543559338088346), 6) AS ndcg_at_10,
       round(avg(CASE WHEN hits > 0 THEN 1 ELSE 0 END), 6) AS hit_at_10,
       round(avg(hits / 10.0), 6) AS precision_at_10,
       round(avg(hits / NULLIF(n_truth, 0)), 6) AS recall_at_10,
       count(*) AS users
FROM per""")
