"""Incremental execution of the landing ingestion (the reference has no streams)."""

from zoneflow.streaming.ingest import incremental_landing_to_raw, landing_schema, stream_checkpoint

__all__ = ["incremental_landing_to_raw", "landing_schema", "stream_checkpoint"]
