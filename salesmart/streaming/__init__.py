"""Incremental processing of a landing folder with Structured Streaming."""

from salesmart.streaming.landing import process_landing_stream  # noqa: F401
