"""Structured Streaming form of the raw landing.

The source system has no streaming operators; its ingest is a batch job. The
same landing (typed CSV read -> ingestion partition columns -> partitioned Parquet)
is offered here as an ``availableNow`` stream so repeated runs pick up only new
files, exactly once, with progress kept in a checkpoint that survives restarts.
"""

from strata.streaming.landing import land_new_files

__all__ = ["land_new_files"]
