"""Structured Streaming versions of the polling rules (readiness, incremental counts,
per-batch tests, freshness and cursor drift)."""
