"""Readers: CSV, Parquet (partitioned raw layer), warehouse tables, JDBC."""

from strata.sources.files import (
    ingest, read_csv_typed, read_csv_wide, read_jdbc, read_raw_parquet, read_table,
)

__all__ = ["ingest", "read_csv_typed", "read_csv_wide", "read_jdbc", "read_raw_parquet", "read_table"]
