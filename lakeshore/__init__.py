"""lakeshore: data-lake operators on plain Spark DataFrames, SQL and
Structured Streaming (see README.md)."""

from lakeshore.operators.cdc import apply_changes, current_rows
from lakeshore.operators.eventlog import expectation_report, flow_event
from lakeshore.operators.privacy import (decrypt_columns, encrypt_columns, pseudonymize,
                                         store_keys, subject_keys)
from lakeshore.operators.quality import expect, expect_or_drop, quality_counts
from lakeshore.sinks.overwrite import replace_where
from lakeshore.sinks.versioned import write_version
from lakeshore.streaming.cdc_stream import ChangeApply, apply_changes_stream

__all__ = [
    "apply_changes", "current_rows", "apply_changes_stream", "ChangeApply",
    "expect", "expect_or_drop", "quality_counts", "flow_event", "expectation_report",
    "pseudonymize", "subject_keys", "store_keys", "encrypt_columns", "decrypt_columns",
    "replace_where", "write_version",
]
