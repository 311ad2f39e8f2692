"""Hand-computed literal cases (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from reelrank.functions.exprs import binary_label, left_pad, multi_hot
from reelrank.operators import metrics as M
from reelrank.operators import prep as P
from reelrank.operators import sequences as S
from reelrank.operators import similarity as SIM
from reelrank.operators.features import index_ids


def test_label_threshold(spark):
    df = spark.createDataFrame([(3.5,), (4.0,), (4.5,)], "rating double")
    assert [r.l for r in df.select(binary_label("rating").alias("l")).collect()] == [0, 1, 1]


def test_set_metric(spark):
    recs = spark.createDataFrame([(1, i) for i in [1, 2, 3, 4]], "userId int, movieId int")
    truth = spark.createDataFrame([(1, i) for i in [2, 4, 9]], "userId int, movieId int")
    r = M.set_metrics_per_user(recs, truth).first()
    assert r.precision == 0.5 and abs(r.recall - 2 / 3) < 1e-12


def test_label_metric(spark):
    topk = spark.createDataFrame([(1, 1, 1), (1, 2, 0), (1, 3, 1)], "userId int, rank int, label int")
    r = M.label_outcomes(topk, topk).first()
    assert abs(r.gain - 1.5) < 1e-9
    assert abs(r.best_gain - 1.630930) < 1e-6
    assert abs(r.ndcg_at_k - 0.919721) < 1e-6
    assert abs(r.precision_at_k - 2 / 3) < 1e-12 and r.recall_at_k == 1
    assert M.label_lists(topk).first().labels == [1, 0, 1]


def test_label_metric_no_positive(spark):
    topk = spark.createDataFrame([(1, 1, 0), (1, 2, 0)], "userId int, rank int, label int")
    r = M.label_outcomes(topk, topk).first()
    assert r.recall_at_k is None and r.ndcg_at_k is None and r.precision_at_k == 0.0


def test_sampled_metric(spark):
    rows = [(1, i, float(100 - i), i in (1, 3)) for i in range(1, 11)]
    rows += [(1, 100 + j, -1.0, True) for j in range(8)]  # the other 8 truth items rank low
    cand = spark.createDataFrame(rows, "userId int, movieId int, score double, is_truth boolean")
    r = M.sampled_metrics_per_user(cand).first()
    assert r.hit == 1 and r.precision == 0.2 and r.recall == 0.2
    assert abs(r.ndcg - 1.5 / 4.543559338) < 1e-6


def test_jaccard(spark):
    req = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "request_id int, movieId int")
    pop = spark.createDataFrame([(7, 2), (7, 3), (7, 4)], "userId int, movieId int")
    r = SIM.jaccard_neighbours(req, pop).first()
    assert r.neighbour == 7 and r.jaccard == 0.5


def test_jaccard_none_shared(spark):
    req = spark.createDataFrame([(1, 1)], "request_id int, movieId int")
    pop = spark.createDataFrame([(7, 2)], "userId int, movieId int")
    assert SIM.jaccard_neighbours(req, pop).count() == 0


@pytest.mark.parametrize("text,status,sorted_,ordered", [
    (" 5, 3,,5 ,1", "ok", [1, 3, 5], [5, 3, 1]),
    ("7", "too_few", [7], [7]),
    ("a,2", "bad_id", [], []),
])
def test_parse_histories(spark, text, status, sorted_, ordered):
    df = spark.createDataFrame([(text,)], "t string")
    r = P.parse_histories(df, "t").first()
    assert r.status == status
    assert list(r.history_sorted) == sorted_ and list(r.history_ordered) == ordered


def test_left_pad(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3],)], "a array<int>")
    assert [list(r.p) for r in df.select(left_pad("a", 4).alias("p")).collect()] == [[0, 0, 1, 2], [0, 1, 2, 3]]
    assert [list(r.p) for r in df.select(left_pad("a", 2).alias("p")).collect()] == [[1, 2], [2, 3]]


def test_serving_sequence(spark):
    items = spark.createDataFrame([(10,), (20,), (30,)], "movieId int")  # tokens 1, 2, 3; mask = 4
    req = spark.createDataFrame([(1, 1, 10), (1, 2, 99), (1, 3, 20)], "request_id int, pos int, movieId int")
    r = S.serving_sequences(req, items, max_len=4).first()
    assert list(r.tokens) == [0, 1, 2, 4]


def test_leave_one_out_and_holdout(spark):
    seqs = spark.createDataFrame([(1, p, 10 + p, 3) for p in range(1, 4)], "userId int, pos int, movieId int, n int")
    r = S.leave_one_out(seqs).first()
    assert r.n_train == 2 and r.valid_item == 13
    s12 = spark.createDataFrame([(1, p, p, 12) for p in range(1, 13)], "userId int, pos int, movieId int, n int")
    assert S.last_n_holdout(s12, 10, 13).count() == 0
    s13 = spark.createDataFrame([(1, p, p, 13) for p in range(1, 14)], "userId int, pos int, movieId int, n int")
    parts = {r.part: r.c for r in S.last_n_holdout(s13, 10, 13).groupBy("part").agg(F.count("*").alias("c")).collect()}
    assert parts == {"input": 3, "truth": 10}


def test_multi_hot_and_skew(spark):
    df = spark.createDataFrame([("A|C",), ("Warlock",)], "g string")
    rows = df.select(multi_hot("g", ["A", "B", "C"]).alias("v")).collect()
    assert list(rows[0].v) == [1, 0, 1]
    ex = df.select(multi_hot("g", ["War"]).alias("v")).collect()[1].v
    sub = df.select(multi_hot("g", ["War"], substring=True).alias("v")).collect()[1].v
    assert list(ex) == [0] and list(sub) == [1]


def test_unseen_index_gets_label_count(spark):
    fit = spark.createDataFrame([(2,), (2,), (1,)], "userId int")
    app = spark.createDataFrame([(9,), (2,), (1,)], "userId int")
    got = {r.userId: r.userIndex for r in index_ids(fit, app, "userId", "userIndex").collect()}
    assert got == {2: 0.0, 1: 1.0, 9: 2.0}


def test_negatives_fewer_than_asked(spark):
    items = spark.createDataFrame([(i,) for i in range(1, 6)], "movieId int")
    rated = spark.createDataFrame([(1, i) for i in range(1, 5)], "userId int, movieId int")
    users = spark.createDataFrame([(1,)], "userId int")
    got = S.sample_negatives(users, rated, items, n=3).collect()
    assert [(r.movieId, r.draw) for r in got] == [(5, 0)]


def test_ideal_dcg_of_ten():
    from reelrank.functions.exprs import ideal_dcg_of_ones
    assert math.isclose(ideal_dcg_of_ones(10), 4.543559338, rel_tol=1e-9)
