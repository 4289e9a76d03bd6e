"""Structured Streaming entry points (continuous idempotent load)."""

from stratus.streaming.upsert import load_batch, load_stream  # noqa: F401
