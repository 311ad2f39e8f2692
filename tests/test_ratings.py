"""The derived ratings: hot users beside others, and no second copy of the rows."""

import datetime

import pytest

from reelrank.sources import tables as T


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """User 1 holds most rows; equal days, repeated pairs and keys, null keys."""
    at = str(tmp_path_factory.mktemp("tables"))
    day = lambda i: datetime.datetime(2020, 1, 1) + datetime.timedelta(days=i * 7 % 13)
    orders = [(o, 1 if o % 3 else o % 5) for o in range(60)] + [(7, 2), (61, None), (None, 3)]
    lines = [(o, (o * 5 + n) % 23, n, float((o * n) % 50 + 1), day(o + n)) for o in range(62) for n in range(4)]
    lines += [(5, None, 9, 3.0, day(2)), (None, 4, 9, 3.0, day(2)), (6, 3, 9, None, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp").write.parquet(f"{at}/lineitem.parquet")
    return at, orders, lines


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _expected(orders, lines):
    best = {}
    low = datetime.datetime(1, 1, 1)
    for o, part, n, q, d in lines:
        for order, user in orders:
            if o is not None and o == order and user is not None:
                key = (d or low, o, n, q if q is not None else -1)
                if (user, part) not in best or key > best[user, part][0]:
                    best[user, part] = key, q, d
    out = []
    for user in {u for u, _ in best}:
        mine = sorted(((d or low, p if p is not None else -1, p, q, d) for (u, p), (_, q, d) in best.items() if u == user), key=lambda r: r[:2])
        for pos, (_, _, p, q, d) in enumerate(mine, 1):
            split = "train" if pos * 10 <= len(mine) * 8 else "validation" if pos * 10 <= len(mine) * 9 else "test"
            out.append((user, p, None if q is None else -(-q // 5) / 2, d, split))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [1_000_000, 30, 0])
def test_hot_users_and_others(spark, folder, monkeypatch, hot):
    at, orders, lines = folder
    monkeypatch.setattr(T, "HOT_LINES", hot)
    assert _rows(T.ratings(spark, at)) == _expected(orders, lines)


def test_rows_are_dealt_by_user_once(spark, folder, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("rows written and joined again for their positions")
    monkeypatch.setattr(T, "with_ordinal", refuse)
    plan = T.ratings(spark, folder[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "rangepartitioning" not in plan
    after_join = plan[:plan.index("REPARTITION_BY_COL")]
    assert after_join.count("Exchange") == 1


def test_tasks_hold_a_bounded_number_of_lines(spark, folder, monkeypatch):
    # merged by their size in bytes, all lines came to one task
    at, orders, lines = folder
    monkeypatch.setattr(T, "LINES_A_TASK", 20)
    got = T.ratings(spark, at)
    assert got.rdd.getNumPartitions() >= len(lines) / 20
    assert _rows(got) == _expected(orders, lines)
