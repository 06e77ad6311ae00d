"""DataFrame to DataFrame operators."""

from tidemark.operators.capture import bucket_hashes, diff_events, diff_events_pruned, snapshot_events
from tidemark.operators.decode import decode_changes, split_dead_letters
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import live, merge, merge_keeping_deletes
from tidemark.operators.offsets import carry_forward, lost_ranges, next_offsets, offsets_document, plan_slice
from tidemark.operators.quality import (
    duplicate_keys,
    key_violations,
    orphans,
    reference_deltas,
    reference_violations,
    row_violations,
    surrogate_key,
)
from tidemark.operators.topics import allow_tables, of_topic, route_topics, topics_of
from tidemark.operators.totals import run_totals, table_counts

__all__ = [
    "allow_tables",
    "bucket_hashes",
    "carry_forward",
    "decode_changes",
    "diff_events",
    "diff_events_pruned",
    "duplicate_keys",
    "key_violations",
    "latest_per_key",
    "live",
    "lost_ranges",
    "merge",
    "merge_keeping_deletes",
    "next_offsets",
    "of_topic",
    "offsets_document",
    "orphans",
    "plan_slice",
    "reference_deltas",
    "reference_violations",
    "route_topics",
    "row_violations",
    "run_totals",
    "snapshot_events",
    "split_dead_letters",
    "surrogate_key",
    "table_counts",
    "topics_of",
]
