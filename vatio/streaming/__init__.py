"""Incremental loading of landed batches with Structured Streaming."""

from .landing_stream import stream_landing
from .page_stream import files_per_trigger, latest_audit, series_verdicts, stream_audit
