"""Incremental ingest with Structured Streaming.

The batch jobs have no streaming counterpart of their own; this package runs
the same calendar cleaning on CSV drops as they arrive (file source,
``foreachBatch``), so a table can be kept current without re-reading old
files.
"""

from .calendar_ingest import compact_calendar, current_calendar, ingest_calendar  # noqa: F401
