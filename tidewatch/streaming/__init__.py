"""Incremental processing of newly arrived batch files."""

from .news_stream import stream_complete_news, stream_news  # noqa: F401
