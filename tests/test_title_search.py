"""Ranked title search against scoring every title in plain Python."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from reelrank.operators import title_search as T

ITEMS = "movieId int, title string"


def _grams(text):
    t = " " + " ".join((text or "").lower().split()) + " "
    return [t[i:i + 3] for i in range(len(t) - 2)] if len(t) > 2 else []


def _brute(items, searches, k, min_chars=2):
    docs = {i: Counter(_grams(t)) for i, t in items if _grams(t)}
    df = Counter(g for c in docs.values() for g in c)
    mean = sum(sum(c.values()) for c in docs.values()) / max(len(docs), 1)
    out = set()
    for name, text in searches:
        if len(" ".join((text or "").lower().split())) < min_chars:
            continue
        asked, found = set(_grams(text)), []
        for i, c in docs.items():
            if asked & set(c):
                dl = sum(c.values())
                s = sum(math.log(1 + (len(docs) - df[g] + .5) / (df[g] + .5)) * c[g] * (T.K1 + 1)
                        / (c[g] + T.K1 * (1 - T.B + T.B * dl / mean)) for g in asked & set(c))
                found.append((-round(s, 6), i))
        out |= {(name, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)}
    return out


def _titles(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(60)]
    return [(i, " ".join(rng.choices(words, k=rng.randint(1, 5))).title()) for i in range(n)], words


def _found(spark, items, searches, k, **how):
    index = T.build_index(spark.createDataFrame(items, ITEMS), **how)
    rows = T.search(index, spark.createDataFrame(searches, "search string, text string"), k)
    return {tuple(r) for r in rows.collect()}


def test_equals_scoring_every_title(spark):
    items, words = _titles(300)
    searches = [(f"s{i}", t) for i, t in enumerate([*words[:12], f"{words[3]} {words[7]}", words[5].upper() + "  " + words[9], words[2][:3] + "zz"])]
    want = _brute(items, searches, 7)
    assert _found(spark, items, searches, 7, block_titles=32) == want
    assert _found(spark, items, searches, 7) == want


def test_nulls_empty_ties_and_long(spark):
    long = "abc " * 5000
    items = [(1, None), (2, ""), (3, "  "), (4, "Red Ring"), (5, "red  ring"), (6, "RED RING"), (7, long), (8, "x")]
    searches = [("null", None), ("empty", ""), ("short", "r"), ("red", "red ring"), ("long", long), ("none", "qqqq"), ("two", "re")]
    got = _found(spark, items, searches, 2)
    assert got == _brute(items, searches, 2)
    assert {(r, i) for s, r, i, _ in got if s == "red"} == {(1, 4), (2, 5)}      # ties by id
    assert _found(spark, [], searches, 2) == set() == _found(spark, items, [], 2)


def test_blocks_below_the_kth_score_are_closed(spark):
    items, words = _titles(400, seed=4)
    items += [(1000 + i, "zyx unlike" if i < 10 else f"{words[i % 60]} unlike") for i in range(200)]
    index = T.build_index(spark.createDataFrame(items, ITEMS), block_titles=20)
    asked = spark.createDataFrame([("z", "zyx unlike")], "search string, text string").select("search", F.explode(T.trigrams(F.col("text"))).alias("gram")).distinct()
    held = index.postings.join(asked, "gram").select("block").distinct().count()
    assert 0 < T._open_blocks(index, asked, 5).count() < held


def test_postings_and_titles_are_not_broadcast(spark):
    from reelrank.plans.q_requests import search_titles_ranked
    plan = search_titles_ranked(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and ("block" in line or "movieId" in line)]
    assert len(joins) == 3 and all("SortMergeJoin" in line for line in joins), plan
