"""Incremental raw landing: each run lands only files not landed before."""

import pytest

from strata.schemas import AUDIO
from strata.session import scratch_path
from strata.sinks.writers import write_csv
from strata.sources.files import read_jdbc, read_raw_parquet
from strata.streaming import land_new_files


def _audio(spark, start, n):
    rows = [(f"k{i}", "0.5", "0.5", "1", "-3.0", "1", "0.1", "0.2", "0.3", "0.4", "0.5", "120.0", "4", "55")
            for i in range(start, start + n)]
    return spark.createDataFrame(rows, ", ".join(f"`{f.name}` string" for f in AUDIO.fields))


def test_landing_is_incremental_and_exactly_once(spark):
    landing, raw, ckpt = (scratch_path(spark, x) for x in ("landing", "raw", "ckpt"))
    write_csv(_audio(spark, 0, 30).coalesce(2), f"{landing}/batch1")
    assert land_new_files(spark, f"{landing}/*", raw, ckpt, as_of="2024-01-01") == 30
    write_csv(_audio(spark, 30, 12).coalesce(1), f"{landing}/batch2")
    assert land_new_files(spark, f"{landing}/*", raw, ckpt, as_of="2024-01-02") == 12
    assert land_new_files(spark, f"{landing}/*", raw, ckpt, as_of="2024-01-03") == 0
    back = read_raw_parquet(spark, raw, drop_partitions=False)
    assert back.count() == 42 and back.select("track_id").distinct().count() == 42
    days = {r["ingestion_day"]: r["count"] for r in back.groupBy("ingestion_day").count().collect()}
    assert days == {1: 30, 2: 12}


def test_jdbc_partitioned_read_needs_all_bounds(spark):
    with pytest.raises(ValueError, match="lower_bound"):
        read_jdbc(spark, "jdbc:none://unused", "t", partition_column="id", num_partitions=4)
