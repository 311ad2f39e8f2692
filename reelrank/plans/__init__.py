"""Model-backed flows (ALS, boosted trees) and the named query registry."""
