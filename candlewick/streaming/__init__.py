"""Structured Streaming jobs, foreachBatch sinks and the progress listener."""
