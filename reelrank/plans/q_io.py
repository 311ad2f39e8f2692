"""Named queries for file sinks and sources: write, read back, compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelrank.operators import metrics as M
from reelrank.operators import sequences as S
from reelrank.plans.frames import Frames
from reelrank.plans.q_sequences import active_train
from reelrank.plans.registry import K, _topk, query, topk_with_title
from reelrank.sources import io


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Item metadata written as CSV and read back with a schema."""
    f = Frames(spark, sf_dir)
    path = io.write_csv(f.movies, io.fresh_path(spark, "movies-csv"))
    return io.read_csv(spark, path)


@query("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    """Exported recommendations (userIndex, title, predicted_rating) as
    JSON, read back with userIndex cast to int."""
    recs = topk_with_title(spark, sf_dir).select(
        F.col("userId").cast("double").alias("userIndex"), "title", "predicted_rating")
    path = io.write_json(recs, io.fresh_path(spark, "recs-json"))
    return io.read_recommendations_json(spark, path)


@query("id_map_roundtrip")
def id_map_roundtrip(spark, sf_dir):
    """Item and user maps persisted and reloaded."""
    f = Frames(spark, sf_dir)
    items = S.id_map(f.movies, "movieId").withColumn("kind", F.lit("item"))
    users = S.id_map(active_train(f), "userId").withColumn("kind", F.lit("user"))
    path = io.save_id_map(items.unionByName(users), io.fresh_path(spark, "id-map"))
    return io.load_id_map(spark, path).select("kind", "id", "idx")


@query("run_log")
def run_log(spark, sf_dir):
    """Parameters and label metrics of the deterministic ranking run
    appended to a run table and read back."""
    f = Frames(spark, sf_dir)
    metrics = M.label_metrics(_topk(f), f.scored_test(), K)
    path = io.fresh_path(spark, "runs")
    return io.log_run(spark, path, "label-ranking", {"k": K, "threshold": 4.0}, metrics)
