"""Structured Streaming form of the bronze/silver load (availableNow trigger)."""

from refinery.streaming.ingest import (  # noqa: F401
    run_incremental, run_incremental_all, start_incremental, stream_extract,
)
