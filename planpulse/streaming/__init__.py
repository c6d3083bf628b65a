"""Incremental ingestion of landed feed pages with Structured Streaming."""

from planpulse.streaming.feed_stream import feed_stream, start_feed_ingest  # noqa: F401
