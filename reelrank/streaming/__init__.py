"""Structured Streaming: request files answered micro-batch by micro-batch
(the batch form of serving one request at a time)."""
