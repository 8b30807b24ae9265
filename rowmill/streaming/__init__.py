"""Structured Streaming: the row-wise operators and dedup over an unbounded source."""

from rowmill.streaming.dedup import compact, dedup_stream, winners, winners_stream
from rowmill.streaming.split import annotate_stream, split_stream

__all__ = ["annotate_stream", "compact", "dedup_stream", "split_stream", "winners", "winners_stream"]
