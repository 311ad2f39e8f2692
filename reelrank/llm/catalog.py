"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from reelrank.llm import (q_alignment, q_exact_dedup, q_fingerprints, q_html_extract, q_line_dedup, q_lm_score, q_minhash,
                          q_packing, q_periodic_runs, q_piece_sampling, q_sharding, q_topk, q_toxicity)

_MODULES = (q_topk, q_packing, q_lm_score, q_minhash, q_sharding, q_piece_sampling, q_exact_dedup, q_line_dedup,
            q_html_extract, q_toxicity, q_alignment, q_periodic_runs, q_fingerprints)
REGISTRY = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
