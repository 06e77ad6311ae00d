"""Structured Streaming jobs."""

from tidemark.streaming.fanout import apply_micro_batch, start_changes
from tidemark.streaming.latest_state import latest_rows, start_latest

__all__ = ["apply_micro_batch", "latest_rows", "start_changes", "start_latest"]
