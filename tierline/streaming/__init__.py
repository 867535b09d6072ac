"""Incremental intake."""

from tierline.streaming.intake import SILVER_PARTITIONS, intake_errors, merge_snapshots, read_stored, run_increment, take_in

__all__ = ["SILVER_PARTITIONS", "intake_errors", "merge_snapshots", "read_stored", "run_increment", "take_in"]
