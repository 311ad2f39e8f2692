"""The pipeline and the registered queries on a small corpus, stage by stage
against brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from reelrank.llm import toxicity
from reelrank.llm.common import ship
from reelrank.llm.q_packing import tokenizer_path
from reelrank.llm.q_toxicity import fitted

from .test_dedup import altered, brute_components


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    ship(spark)
    rng = random.Random(12)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(160):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 90))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "worthless"]))
        rows.append((i, " ".join(words)))
        if i < 120:
            labels.append((i, 1, int(toxic)))
    for i in range(160, 200):
        rows.append((i, rows[rng.randrange(160)][1]))
    for i in range(200, 260):
        rows.append((i, altered(rows[rng.randrange(160)][1].split(), rng.choice([0.005, 0.02, 0.1]), rng)))
    rows += [(300, None), (301, ""), (302, " "), (303, "x " * 20_000)]
    base = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base), rows


_models = {}


def plain_score(text, spark, sf_dir):
    """The model's score worked out feature by feature."""
    if sf_dir not in _models:
        m = fitted(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark, sf_dir)
        _models[sf_dir] = dict(zip(m.features.tolist(), m.weights.tolist())), m.bias
    weights, bias = _models[sf_dir]
    found = {h for w in set((text or "").lower().split()) for s in toxicity._feature_sets([w]) for h in s.tolist()}
    return 1 / (1 + math.exp(-bias - sum(weights.get(h, 0.0) for h in found)))


def test_stages_as_brute_force(spark, corpus, tmp_path):
    from tokenizers import Tokenizer
    sf_dir, rows = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "packing"]
    kept = {"": dict(rows)}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < 3:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if k < 3:
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
            assert len(kept[name]) == docs.count()
    assert kept["toxicity"] == {i: t for i, t in rows if plain_score(t, spark, sf_dir) < 0.5}
    bad = {"idiot", "scum", "worthless"}
    clean = {i for i, t in rows if not bad & set((t or "").split())}
    assert clean <= set(kept["toxicity"]) and len(set(kept["toxicity"]) - clean) < 0.2 * (len(rows) - len(clean))
    best = {}
    for i, t in kept["toxicity"].items():
        best[t or ""] = max(i, best.get(t or "", -1))
    assert kept["exact_dedup"] == {i: t for i, t in kept["toxicity"].items() if best[t or ""] == i}
    _, low = brute_components(list(kept["exact_dedup"].items()), 5)
    assert kept["minhash_near_dedup"] == {i: t for i, t in kept["exact_dedup"].items() if low[i] == i}
    assert len(kept["minhash_near_dedup"]) < len(kept["exact_dedup"]) < len(kept["toxicity"]) < len(rows)
    whole, ids = Tokenizer.from_file(tokenizer_path()), {}
    for r in docs.orderBy("doc_id", "start").collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert ids == {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in kept["minhash_near_dedup"].items()}
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.columns == docs.columns
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, run.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_pipeline_without_documents(spark, corpus, tmp_path):
    sf_dir, _ = corpus
    spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").filter("false").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_with_nulls_and_repeated_rows(spark, corpus):
    sf_dir, rows = corpus
    odd = [(None, rows[1][1]), (None, None), (1, rows[1][1]), (1, rows[1][1]), (2, None)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in odd],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() >= 2


def test_registered(spark):
    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {f"{n.split('_')[0]}_" for n in names if n.startswith("op")}
    assert "pipeline" in names and "pipeline" not in E.oracle_sql()


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("key", ["op1_topk_bitslices", "op3_lm_score", "op5_sharding", "op7_exact_dedup", "op8_line_dedup"])
def test_matches_sql(spark, key):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    want = sorted(tuple(map(_norm, r)) for r in res.fetchall()) if key != "op5_sharding" else sorted(map(repr, res.fetchall()))
    df = E.queries()[key](spark, sf).select(*cols)
    got = [tuple(map(_norm, r)) for r in df.collect()]
    assert (sorted(got) if key != "op5_sharding" else sorted(map(repr, got))) == want


def test_held_out_rows_follow_crc32(spark):
    from reelrank.llm.q_toxicity import held_out
    got = {r.doc_id: r.h for r in spark.range(200).select(F.col("id").alias("doc_id"), held_out("id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}
