"""reelrank: recommendation analytics written as Spark DataFrame jobs.

Layout
------
sources/    table readers, derived rating/item tables, file sinks and sources
functions/  column expressions (arrays, hashing, metric formulas, parsing)
operators/  DataFrame -> DataFrame building blocks (prep, candidates, ranking,
            metrics, sequences, similarity, enrichment, blending)
plans/      model-backed flows (ALS, boosted trees, cold start, requests) and
            the named query registry used by ``__spark_entry__``
streaming/  micro-batch request scoring on Structured Streaming
"""

from reelrank.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
