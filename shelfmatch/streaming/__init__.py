"""Structured Streaming: the feed-driven refresh of the roll-up (``refresh``)."""
