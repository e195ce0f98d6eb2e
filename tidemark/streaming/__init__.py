"""Feeds loaded as streams."""

from tidemark.streaming.feeds import feed_source, feed_stream

__all__ = ["feed_source", "feed_stream"]
