"""Properties of the skew-safe building blocks, sampling and plans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelrank.operators import candidates as C
from reelrank.operators import rank as R
from reelrank.operators import sequences as S
from reelrank.operators.ordinal import with_ordinal

from .conftest import SF


def _skewed(spark, n=4000):
    # user 0 holds half of all rows
    rows = [(0 if i % 2 == 0 else i % 37, i, (i * 7919) % 1000) for i in range(n)]
    return spark.createDataFrame(rows, "userId int, movieId int, ts int")


def test_ordinal_matches_row_number(spark):
    df = _skewed(spark)
    w = Window.partitionBy("userId").orderBy("ts", "movieId")
    want = {(r.userId, r.movieId): (r.p, r.c) for r in df.select(
        "userId", "movieId", F.row_number().over(w).alias("p"),
        F.count("*").over(Window.partitionBy("userId")).alias("c")).collect()}
    for parts in (None, 1, 3, 16):
        got = {(r.userId, r.movieId): (r.pos, r.n) for r in
               with_ordinal(df, "userId", ["ts", "movieId"], num_partitions=parts).collect()}
        assert got == want


def test_hot_key_is_split_across_partitions(spark):
    df = _skewed(spark)
    ranged = df.repartitionByRange(8, "userId", "ts", "movieId")
    per_part = ranged.filter("userId = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_part) > 1


def test_negatives_exclude_rated_and_are_stable(spark):
    items = spark.createDataFrame([(i,) for i in range(200)], "movieId int")
    rated = spark.createDataFrame([(u, (u * 13 + j) % 200) for u in range(20) for j in range(30)],
                                  "userId int, movieId int")
    users = rated.select("userId").distinct()
    a = S.sample_negatives(users, rated, items, n=50, seed=3)
    rows = a.collect()
    rated_set = {(r.userId, r.movieId) for r in rated.collect()}
    assert not any((r.userId, r.movieId) in rated_set for r in rows)
    counts = {}
    for r in rows:
        counts[r.userId] = counts.get(r.userId, 0) + 1
    assert set(counts.values()) == {50}
    b = S.sample_negatives(users.repartition(7), rated.repartition(5), items.repartition(3), n=50, seed=3)
    assert sorted((r.userId, r.movieId, r.draw) for r in b.collect()) == \
        sorted((r.userId, r.movieId, r.draw) for r in rows)


def test_masking_rates(spark):
    n_users, length = 300, 60
    seqs = spark.createDataFrame([(u, p, (u * 31 + p) % 500 + 1, length) for u in range(n_users)
                                  for p in range(1, length + 1)], "userId int, pos int, movieId int, n int")
    items = spark.createDataFrame([(i,) for i in range(1, 501)], "movieId int")
    out = S.masked_sequences(seqs, items, None, 0, max_len=80, mask_prob=0.15, seed=1).collect()
    chosen = masked = total = 0
    for r in out:
        toks, labels, flags = list(r.tokens), list(r.labels), list(r.is_masked)
        assert len(toks) == 80 and toks[:80 - (length - 1)] == [0] * (80 - (length - 1))
        for t, lab, fl in zip(toks, labels, flags):
            if lab == 0:
                continue
            total += 1
            chosen += fl
            masked += int(t == 501)
    assert abs(chosen / total - 0.15) < 0.02
    assert abs(masked / chosen - 0.8) < 0.05


def test_top_k_plans_group_limit_and_anti_join(spark):
    from reelrank.plans.frames import Frames
    f = Frames(spark, SF)
    seen = C.seen_items(f.train.select("userId", "movieId"), f.test)
    plan = R.top_k(C.drop_seen_anti(f.scored_test(), seen), 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "LeftAnti" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_scan_pushes_filter_and_prunes_columns(spark):
    from reelrank.sources.tables import read_table
    li = read_table(spark, SF, "lineitem").filter(F.col("l_quantity") >= 20).select("l_partkey")
    plan = li._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,20.0)]" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def _brute_jaccard(req_rows, pop_rows, k):
    from collections import defaultdict
    A, B = defaultdict(set), defaultdict(set)
    for r, i in req_rows:
        A[r].add(i)
    for u, i in pop_rows:
        B[u].add(i)
    out = {}
    for r, a in A.items():
        scored = []
        for u, b in B.items():
            inter = len(a & b)
            if inter:
                scored.append((-inter / len(a | b), u, inter))
        out[r] = [(u, inter) for _, u, inter in sorted(scored)[:k]]
    return out


def test_jaccard_hot_items_exact(spark):
    from reelrank.operators.similarity import jaccard_neighbours
    import random
    rng = random.Random(5)
    pop = set()
    for u in range(300):
        if rng.random() < 0.9:
            pop.add((u, 0))                 # item 0: almost every user
        if rng.random() < 0.5:
            pop.add((u, 1))                 # item 1: half of the users
        for _ in range(rng.randint(0, 6)):
            pop.add((u, rng.randint(2, 80)))
    req = set()
    for r in range(40):
        for _ in range(rng.randint(1, 5)):
            req.add((1000 + r, rng.choice([0, 1] + list(range(2, 80)))))
    pdf = spark.createDataFrame(sorted(pop), "userId int, movieId int")
    rdf = spark.createDataFrame(sorted(req), "request_id int, movieId int")
    for k in (1, 3):
        want = _brute_jaccard(req, pop, k)
        for hot_quantile in (0.0, 0.5, 0.99):        # from nearly all items hot (over 40) to one
            got = {}
            for row in jaccard_neighbours(rdf, pdf, k=k, hot_quantile=hot_quantile).orderBy("request_id", "rank").collect():
                got.setdefault(row.request_id, []).append((row.neighbour, row.inter))
            assert got == {r: v for r, v in want.items() if v}, (k, hot_quantile)


def test_top_k_excluding_matches_brute_force(spark):
    import random
    from reelrank.operators.rank import top_k_excluding
    rng = random.Random(11)
    lists = [(g, i, float(rng.randint(0, 50))) for g in range(3) for i in range(300)]
    reqs = [(r, r % 3) for r in range(30)]
    excl = set()
    for r in range(30):
        n = 250 if r == 7 else rng.randint(0, 12)          # request 7 excludes most of its list
        for i in rng.sample(range(300), n):
            excl.add((r, i))
    L = spark.createDataFrame(lists, "g int, movieId int, score double")
    Q = spark.createDataFrame(reqs, "request_id int, g int")
    X = spark.createDataFrame(sorted(excl), "request_id int, movieId int")
    got = sorted((r.request_id, r.rank, r.movieId) for r in top_k_excluding(L, Q, X, 10, "g").collect())
    want = []
    for r, g in reqs:
        cand = sorted(((-s, i) for gg, i, s in lists if gg == g and (r, i) not in excl))[:10]
        want += [(r, k + 1, i) for k, (_, i) in enumerate(cand)]
    assert got == sorted(want)


def _draws(spark, seed, users=300, n=10, n_items=1000):
    items = spark.createDataFrame([(i,) for i in range(n_items)], "movieId int")
    rated = spark.createDataFrame([(u, (u * 7 + j) % n_items) for u in range(users) for j in range(5)], "userId int, movieId int")
    got = S.sample_negatives(rated.select("userId"), rated, items, n=n, seed=seed).collect()
    out = {}
    for r in got:
        out.setdefault(r.userId, {})[r.draw] = r.movieId
    return out


def test_negative_draws_are_independent(spark):
    """Items come up equally often, in no fixed order, and neither two users
    nor two seeds share their draws."""
    a, b = _draws(spark, 1), _draws(spark, 2)
    n_items, users, n = 1000, 300, 10
    counts = [0] * n_items
    for d in a.values():
        assert sorted(d) == list(range(n)) and len(set(d.values())) == n
        for i in d.values():
            counts[i] += 1
    mean = users * n / n_items
    chi = sum((c - mean) ** 2 / mean for c in counts)
    assert abs(chi - (n_items - 1)) < 6 * (2 * n_items) ** 0.5
    gaps = {(d[t + 1] - d[t]) % n_items for d in a.values() for t in range(n - 1)}
    assert len(gaps) > 800
    overlap = sum(len(set(a[u].values()) & set(b[u].values())) for u in a) / (users * n)
    between = sum(len(set(a[u].values()) & set(a[u + 1].values())) for u in range(users - 1)) / ((users - 1) * n)
    assert overlap < 0.03 and between < 0.03


def test_dense_users_get_every_unrated_item(spark):
    items = spark.createDataFrame([(i,) for i in range(50)], "movieId int")
    rated = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 1)], "userId int, movieId int")
    got = S.sample_negatives(rated.select("userId"), rated, items, n=30, seed=4).collect()
    assert sorted(r.movieId for r in got if r.userId == 1) == list(range(40, 50))
    two = [r.movieId for r in got if r.userId == 2]
    assert len(two) == len(set(two)) == 30 and 1 not in two


def test_masked_positions_are_independent(spark):
    n_users, length = 600, 61
    seqs = spark.createDataFrame([(u, p, (u * 31 + p) % 500 + 1, length) for u in range(n_users)
                                  for p in range(1, length + 1)], "userId int, pos int, movieId int, n int")
    items = spark.createDataFrame([(i,) for i in range(1, 501)], "movieId int")
    gaps = {}
    for r in S.masked_sequences(seqs, items, None, 0, max_len=80, mask_prob=0.15, seed=3).select("is_masked").collect():
        at = [i for i, f in enumerate(r.is_masked) if f]
        for x, y in zip(at, at[1:]):
            gaps[y - x] = gaps.get(y - x, 0) + 1
    total = sum(gaps.values())
    assert len(gaps) > 20
    for g in range(1, 8):       # geometric, a little short of it because sequences end
        assert abs(gaps[g] / total - 0.15 * 0.85 ** (g - 1)) < 0.03


def test_exclude_ids_has_one_null_rule(spark):
    from reelrank.operators.prep import exclude_ids, id_frame
    df = spark.createDataFrame([(None,), (1,), (2,)], "movieId int")
    for extra in ([], list(range(10, 2000))):
        for ids in ([1, *extra], [1, None, *extra], id_frame(spark, [1, *extra], "x")):
            got = sorted((r.movieId or 0) for r in exclude_ids(df, ids).collect())
            assert got == [0, 2]


def test_next_items_complete_and_exact(spark):
    import random
    rng = random.Random(8)
    trans = {(rng.randrange(30), rng.randrange(30)): rng.randrange(1, 5) for _ in range(60)}
    pop = {i: rng.randrange(0, 4) for i in range(40)}
    reqs = {r: rng.sample(range(40), rng.randrange(1, 36)) for r in range(25)}
    reqs[99] = [7] * 3 + [1000]                       # repeated and unknown items
    T = spark.createDataFrame([(a, b, c) for (a, b), c in trans.items()], "prev_item int, next_item int, transitions long")
    P = spark.createDataFrame(list(pop.items()), "movieId int, count long")
    R = spark.createDataFrame([(r, p, i) for r, items in reqs.items() for p, i in enumerate(items)], "request_id int, pos int, movieId int")
    got = {}
    for r in S.next_items(R, T, P, 10).orderBy("request_id", "rank").collect():
        got.setdefault(r.request_id, []).append((r.movieId, r.score))
    for r, items in reqs.items():
        score = {i: sum(trans.get((a, i), 0) for a in set(items)) for i in pop if i not in items}
        want = sorted(score, key=lambda i: (-score[i], -pop[i], i))[:10]
        assert got.get(r, []) == [(i, score[i]) for i in want]


def test_cosine_blocks_match_brute_force(spark):
    import random

    import numpy as np
    from reelrank.operators.similarity import cosine_neighbours
    rng = random.Random(3)
    prof = {u: {g: rng.random() for g in rng.sample("abcdefgh", rng.randrange(1, 5))} for u in range(60)}
    rows = [(u, g, float(w / np.sqrt(sum(x * x for x in p.values())))) for u, p in prof.items() for g, w in p.items()]
    users = spark.createDataFrame(rows, "userId int, genre string, weight double")
    reqs = users.filter("userId < 20").withColumn("request_id", -F.col("userId")).withColumnRenamed("userId", "me")
    for block in (7, 4096):
        got = {}
        for r in cosine_neighbours(reqs, users, 5, exclude_self="me", block=block).orderBy("request_id", "rank").collect():
            got.setdefault(-r.request_id, []).append((r.neighbour, r.cosine))
        unit = {u: {g: w for x, g, w in rows if x == u} for u in prof}
        for u in range(20):
            cos = {v: round(sum(w * unit[v].get(g, 0) for g, w in unit[u].items()), 12) for v in unit if v != u}
            want = sorted((v for v in cos if cos[v] > 0), key=lambda v: (-cos[v], v))[:5]
            assert [v for v, _ in got[u]] == want


def test_request_rule_for_known_and_unknown_users(spark):
    """A training user excludes the own history; a logged-in user without one
    and an anonymous request borrow the neighbour's; without a neighbour only
    the given items are left out. Every request gets 10 rows."""
    from reelrank.plans import gbt as G
    from reelrank.plans import q_gbt
    from reelrank.plans.frames import Frames
    from reelrank.plans.q_requests import exclusions, neighbours, unknown
    f = Frames(spark, SF)
    user = f.train.agg(F.min("userId")).first()[0]
    own = {r.movieId for r in f.train.filter(F.col("userId") == user).collect()}
    given = sorted(own)[:3]
    rows = [(1, user, i) for i in given] + [(2, 999_999, i) for i in given] + [(3, None, i) for i in given]
    rows += [(4, 999_998, 888_888), (5, None, 888_888)]
    reqs = spark.createDataFrame(rows, "request_id int, userId int, movieId int")
    nb = neighbours(f, unknown(f, reqs))
    found = {r.request_id: r.neighbour for r in nb.collect()}
    assert set(found) == {2, 3} and found[2] == found[3]
    theirs = {r.movieId for r in f.train.filter(F.col("userId") == found[2]).collect()}
    excl = exclusions(f, reqs, nb)
    got = {}
    for r in excl.collect():
        got.setdefault(r.request_id, set()).add(r.movieId)
    assert got[1] == own and got[2] == got[3] == theirs | set(given) and got[4] == got[5] == {888_888}
    who = reqs.select("request_id", "userId").distinct()
    items = f.train.select("movieId").distinct().join(f.movies, "movieId")
    fm, model = q_gbt.feature_model(f), q_gbt.final_model(f)
    top = {}
    for r in G.recommend_catalogue(model, fm, who, excl, items, 10).orderBy("request_id", "rank").collect():
        top.setdefault(r.request_id, []).append((r.movieId, r.score))
    assert {r: len(v) for r, v in top.items()} == {r: 10 for r in range(1, 6)}
    assert top[2] == top[3] and top[4] == top[5]      # no user and an unseen user are scored alike


def test_missing_year_keeps_its_row(spark):
    from reelrank.plans import gbt as G
    rows = [(1, 1, 1, "A|B", "1990"), (1, 2, 0, "B", None), (2, 1, 1, None, "x")]
    df = spark.createDataFrame(rows, "userId int, movieId int, label int, genres string, year string")
    fm = G.fit_features(df)
    got = {(r.userId, r.movieId): (r.year, r.yearMissing) for r in fm.transform(df).collect()}
    assert got == {(1, 1): (1990, 0), (1, 2): (0, 1), (2, 1): (0, 1)}
    assert fm.feature_names()[-1] == "yearMissing"


def test_unseen_top_k_with_a_heavy_user(spark):
    """A user who has seen all but two items, and one block per few ids."""
    import numpy as np
    from reelrank.plans import als as A
    train = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(40) if (u + i) % 3],
                                  "userId int, movieId int, rating double")
    model = A.fit_als(train, rank=4, max_iter=3)
    seen = spark.createDataFrame([(0, i) for i in range(38)] + [(1, 5), (1, 999)], "userId int, movieId int")
    users = spark.createDataFrame([(0,), (1,), (2,), (500,)], "userId int")
    got = {}
    for r in A.recommend_unseen(model, users, seen, k=5, block=8).orderBy("userId", "rank").collect():
        got.setdefault(r.userId, []).append(r.movieId)
    U = {r.id: np.array(r.features, np.float32) for r in model.userFactors.collect()}
    I = {r.id: np.array(r.features, np.float32) for r in model.itemFactors.collect()}
    gone = {(r.userId, r.movieId) for r in seen.collect()}
    for u in (0, 1, 2):
        want = sorted((i for i in I if (u, i) not in gone), key=lambda i: (-float(U[u] @ I[i]), i))[:5]
        assert got[u] == want
    assert 500 not in got and len(got[0]) <= 2


def test_unseen_candidates_shuffle_no_pairs(spark):
    """Each request with each item once but the excluded ones; nothing moves
    after the pairs are made."""
    items = spark.createDataFrame([(i,) for i in range(50)] + [(3,), (None,)], "movieId int")
    reqs = spark.createDataFrame([(r,) for r in range(6)] + [(2,), (None,)], "request_id int")
    gone = {(r, (r * 7 + j) % 60) for r in range(6) for j in range(r * 4)} | {(0, i) for i in range(50)}
    excl = spark.createDataFrame(sorted(gone) * 2 + [(1, None), (None, 4)], "request_id int, movieId bigint")
    for block in (7, 4096):
        out = C.unseen_candidates(reqs, items, excl, block=block)
        rows = [(r.request_id, r.movieId) for r in out.collect()]
        want = {(r, i) for r in [*range(6), None] for i in [*range(50), None]} - gone
        assert len(rows) == len(want) and set(rows) == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan


def test_ranges_are_exploded_in_several_tasks(spark):
    # the short rows before the explosion were merged into one task
    need = spark.range(64).withColumn("n", F.lit(100))
    got = S.explode_range(need, "n").withColumn("task", F.spark_partition_id())
    assert got.count() == 6400 and got.select("task").distinct().count() > 1
    assert S.explode_range(need, "n", tasks=9).rdd.getNumPartitions() == 9


def test_draws_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    rated = spark.createDataFrame([(u, i) for u in range(20) for i in range(u)] + [(3, None), (4, 777)], "userId int, movieId int")
    items = spark.createDataFrame([(i * 3,) for i in range(40)] * 2, "movieId int")
    draw = lambda: sorted(map(tuple, S.sample_negatives(rated.select("userId"), rated, items, n=12, seed=5).collect()))
    few = draw()
    monkeypatch.setattr(S, "DRAWS_A_TASK", 20)
    assert draw() == few
    mine = {u: [i for v, i, _ in few if v == u] for u in range(1, 20)}
    own = {u: set(range(u)) for u in mine}
    assert all(len(set(m)) == 12 and not own[u] & set(m) and all(i % 3 == 0 for i in m) for u, m in mine.items())
