"""Structured Streaming: row checks on streams, split and metrics per micro-batch, key counts over all of them."""

from rowguard.streaming.quality import annotate_stream, metrics_stream, quarantine_stream
from rowguard.streaming.state import aggregate_bounds, duplicate_rows, key_state, state_stream

__all__ = ["aggregate_bounds", "annotate_stream", "duplicate_rows", "key_state", "metrics_stream", "quarantine_stream", "state_stream"]
