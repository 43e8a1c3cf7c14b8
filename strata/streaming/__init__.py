"""Structured Streaming: incremental, checkpointed ingest."""

from strata.streaming.ingest import (MESSAGE_SCHEMA, StreamIngestResult, ingest_evolving,
                                     ingest_files_incremental, ingest_incremental, message_stream)

__all__ = ["MESSAGE_SCHEMA", "StreamIngestResult", "ingest_evolving", "ingest_files_incremental",
           "ingest_incremental", "message_stream"]
