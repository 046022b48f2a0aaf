"""Incremental, exactly-once landing of CSV files into the raw layer."""

from __future__ import annotations

import datetime as _dt
from typing import Optional, Union

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from strata.operators.ingest import add_ingestion_partition
from strata.schemas import AUDIO, RAW_PARTITION_COLS
from strata.session import hadoop_path, path_exists


def land_new_files(spark: SparkSession, landing_dir: str, raw_path: str, checkpoint: str, *,
                   schema: StructType = AUDIO, as_of: Union[str, _dt.date, None] = None,
                   max_files_per_trigger: Optional[int] = None) -> int:
    """Land every CSV file under ``landing_dir`` not yet landed, then stop.

    Returns the number of rows this run added, counted from the file footers before and
    after. ``checkpoint`` (a shared folder) records which files were processed; the
    Parquet sink's commit log makes readers see only complete batches, and only those: a
    folder that batch jobs write to is refused, as readers would lose its other files.
    """
    streamed = path_exists(spark, f"{raw_path}/_spark_metadata")
    if not streamed and path_exists(spark, raw_path):
        fs, folder = hadoop_path(spark, raw_path)
        if fs.listStatus(folder):
            raise ValueError(f"{raw_path} holds files that no stream wrote: give the stream a folder of its own")
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stamped = add_ingestion_partition(reader.csv(landing_dir), as_of)
    rows = lambda: spark.read.schema(stamped.schema).parquet(raw_path).count()
    before = rows() if streamed else 0
    q = (stamped.writeStream.format("parquet").option("path", raw_path)
         .option("checkpointLocation", checkpoint).partitionBy(*RAW_PARTITION_COLS)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return rows() - before if path_exists(spark, f"{raw_path}/_spark_metadata") else 0
