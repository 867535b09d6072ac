"""Readers and writers."""

from tierline.sources.publish import publish, superseded, switch
from tierline.sources.readers import (
    capture_envelopes,
    envelope_errors,
    history_errors,
    read_envelopes,
    read_history_csv,
    read_landed_text,
    read_reference,
    read_table,
    reference_for_day,
    restrict_regions,
)
from tierline.sources.writers import append_partitions, grow_table, register_table, replace_partitions

__all__ = [
    "append_partitions",
    "capture_envelopes",
    "envelope_errors",
    "grow_table",
    "history_errors",
    "publish",
    "read_envelopes",
    "read_history_csv",
    "read_landed_text",
    "read_reference",
    "read_table",
    "reference_for_day",
    "register_table",
    "replace_partitions",
    "restrict_regions",
    "superseded",
    "switch",
]
