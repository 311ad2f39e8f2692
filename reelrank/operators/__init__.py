"""DataFrame -> DataFrame building blocks (preparation, candidates, ranking,
metrics, sequences, features, similarity, enrichment, blending)."""
