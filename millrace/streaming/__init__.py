"""Structured Streaming jobs, run to completion with ``availableNow``."""
