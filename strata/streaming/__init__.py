"""Incremental ingestion of raw extracts with Structured Streaming.

The reference has no streaming operators. This package only re-runs the
row-local part of the cleaning layer (C1, C3, C4, C8, F1-F5) on files as
they arrive; group-level steps (unit mode, one-hot topics, label codes,
marts) stay in the batch plans, which read the streamed output.
"""

from strata.streaming.ingest import clean_rows, start_ingest  # noqa: F401
