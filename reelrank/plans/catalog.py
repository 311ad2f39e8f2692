"""All named queries and their SQL, loaded together."""

from __future__ import annotations

from reelrank.plans import q_gbt, q_io, q_models, q_requests, q_sequences  # noqa: F401
from reelrank.plans.oracle import ORACLE
from reelrank.plans.registry import REGISTRY

__all__ = ["REGISTRY", "ORACLE"]
