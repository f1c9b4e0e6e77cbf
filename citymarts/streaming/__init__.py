"""Structured Streaming entry points: incremental raw sync and the
streaming newest-wins fact upsert."""

from citymarts.streaming.raw_sync import raw_sync_stream
from citymarts.streaming.fact_upsert import fact_upsert_stream

__all__ = ["raw_sync_stream", "fact_upsert_stream"]
