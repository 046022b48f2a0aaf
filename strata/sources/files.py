"""Scans. Each returns a lazy DataFrame; nothing is counted or collected here."""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.schemas import AUDIO, RAW_PARTITION_COLS


def read_csv_typed(spark: SparkSession, path: str, schema: StructType = AUDIO, *,
                   header: bool = True) -> DataFrame:
    """Header CSV with an explicit schema; a malformed field or short row gives null.

    Splittable (no multi-line records), so large files are read in parallel chunks.
    """
    return (spark.read.option("header", header).option("mode", "PERMISSIVE")
            .schema(schema).csv(path))


def read_csv_wide(spark: SparkSession, path: str, *, multi_line: bool = True,
                  encoding: str = "UTF-8") -> DataFrame:
    """Header CSV read as all strings, columns found by name.

    RFC-4180 quoting: ``""`` inside quotes is a quote, quoted commas and newlines are
    legal (``multi_line``). Undecodable bytes become U+FFFD. A multi-line CSV file
    is not splittable, so land it once into Parquet before heavy work.
    """
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("escape", '"').option("quote", '"')
            .option("multiLine", multi_line).option("encoding", encoding)
            .option("mode", "PERMISSIVE").csv(path))


def read_raw_parquet(spark: SparkSession, path: str, *, as_of: Optional[_dt.date] = None,
                     drop_partitions: bool = True,
                     schema: Optional[StructType] = None) -> DataFrame:
    """Scan a date-partitioned raw dataset.

    ``as_of`` keeps one ingestion day and is pruned at the directory level;
    the default reads every day. Partition columns are dropped unless asked.
    ``schema`` projects to the declared columns (extra landed columns, such as a
    load timestamp, are left out and never read).
    """
    df = spark.read.parquet(path)
    if schema is not None:
        keep = [f.name for f in schema.fields]
        if not drop_partitions:
            keep += [c for c in RAW_PARTITION_COLS if c in df.columns]
        df = df.select(*keep)
    if as_of is not None:
        df = df.filter((F.col("ingestion_year") == as_of.year)
                       & (F.col("ingestion_month") == as_of.month)
                       & (F.col("ingestion_day") == as_of.day))
    if drop_partitions:
        from strata.operators.ingest import drop_partition_columns
        df = drop_partition_columns(df)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan whose input splits cannot occupy the cluster.

    A source stored as a few large files (or one Parquet row group) is read by a
    few tasks, and every narrow step before the first shuffle inherits that
    parallelism. When the scan has fewer partitions than the default parallelism
    this adds one cheap shuffle of the scanned columns; a scan of many files is
    returned unchanged (no shuffle at scale).
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, *, user: Optional[str] = None,
              password: Optional[str] = None, driver: Optional[str] = None,
              partition_column: Optional[str] = None, lower_bound: Optional[int] = None,
              upper_bound: Optional[int] = None, num_partitions: Optional[int] = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Full-table JDBC scan.

    Give ``partition_column`` with bounds and ``num_partitions`` to read with that
    many parallel range queries instead of one connection.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    r = r.option("fetchsize", fetch_size)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return r.load()


SOURCES = ("catalogue", "audio_features")


def ingest(spark: SparkSession, source: str, cfg: Mapping) -> DataFrame:
    """Pick the reader for one named source, checking its options before any work."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; expected one of {SOURCES}")
    if source == "catalogue":
        missing = [k for k in ("jdbc_url", "jdbc_user", "jdbc_password") if not cfg.get(k)]
        if missing:
            raise ValueError(f"source 'catalogue' needs {', '.join(missing)}")
        return read_jdbc(spark, cfg["jdbc_url"], cfg.get("jdbc_table", "catalogue"),
                         user=cfg["jdbc_user"], password=cfg["jdbc_password"],
                         driver=cfg.get("jdbc_driver"),
                         partition_column=cfg.get("partition_column"),
                         lower_bound=cfg.get("lower_bound"), upper_bound=cfg.get("upper_bound"),
                         num_partitions=cfg.get("num_partitions"))
    if not cfg.get("input_path"):
        raise ValueError("source 'audio_features' needs input_path")
    return read_csv_typed(spark, cfg["input_path"], AUDIO)


__all__ = ["RAW_PARTITION_COLS", "SOURCES", "ingest", "read_csv_typed", "read_csv_wide",
           "read_jdbc", "read_raw_parquet", "read_table", "spread"]
