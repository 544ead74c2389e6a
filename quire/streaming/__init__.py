"""Structured Streaming jobs (file source, availableNow trigger, foreachBatch)."""
