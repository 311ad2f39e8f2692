"""Serving requests as a stream.

The reference serves one request at a time from a model endpoint. Here
request files (one row per request: request_id, history) land in a folder and
a Structured Streaming query answers each micro-batch with the same batch
operator used everywhere else (``operators.sequences.next_items``). A request
is one row, so no micro-batch holds a part of one. Each micro-batch overwrites its own ``epoch=<id>`` folder, so a retried batch
replaces its output instead of appending a second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelrank.operators.sequences import next_items

REQUEST_SCHEMA = "request_id int, history array<int>"


def start_next_item_stream(spark: SparkSession, request_dir: str, transitions: DataFrame,
                           popularity: DataFrame, sink_dir: str, checkpoint_location: str, k: int = 10,
                           available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes the files
    present at start and stops. A request with an empty history has no row
    in the answer."""
    stream = spark.readStream.schema(REQUEST_SCHEMA).parquet(request_dir)

    def answer(batch: DataFrame, epoch_id: int) -> None:
        items = batch.select("request_id", F.posexplode("history").alias("pos", "movieId"))
        recs = next_items(items, transitions, popularity, k).withColumn("epoch", F.lit(epoch_id))
        recs.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/epoch={epoch_id}")

    writer = (stream.writeStream.foreachBatch(answer)
                    .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
