"""Structured Streaming: checked incremental appends into the table catalog."""

from estatelens.streaming.checked_append import checked_append_stream  # noqa: F401
