"""Structured Streaming entry points.

The row-local operators (record builders, normalisation, rendering, token
counts, gates, cleaning) are plain column expressions, so they run unchanged on
a streaming DataFrame. Selection operators that need a global order (first-N,
bucketed quotas) are batch-only by nature.
"""
