"""Writers: partitioned Parquet, warehouse tables, JDBC, CSV."""

from strata.sinks.writers import (
    ensure_database, write_csv, write_jdbc, write_raw_parquet, write_table,
)

__all__ = ["ensure_database", "write_csv", "write_jdbc", "write_raw_parquet", "write_table"]
