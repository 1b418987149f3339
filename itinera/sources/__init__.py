"""Batch-slice readers and idempotent sinks."""

from itinera.sources.tables import (
    read_table, read_slice, sales_lines, latest_extract, literal_dim, like,
)
from itinera.sources.sinks import (
    append_slice, replace_batch, replace_slice, apply_updates, insert_absent, insert_new_members,
    register_keys, log_step, drop_rows,
)

__all__ = [n for n in dir() if not n.startswith("_")]
