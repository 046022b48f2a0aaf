"""Scratch in buckets: the silver job's sources and unified rows."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strata.plans import silver
from strata.plans.jobs import JobConfig, build_silver, land_raw
from strata.schemas import AUDIO, AUDIO_COLS, CATALOGUE, KEY
from strata.session import scratch_database, scratch_path
from strata.sinks import bucketed
from strata.sinks.bucketed import bucket_count, largest_bucket, write_bucketed
from strata.sources.fixtures import wide_source
from tests.conftest import SF_SMALL, rows


def odd_sources(spark, n=3000):
    """Repeated, null and blank keys, keys that only one source has, a null and a frequent artist."""
    i = F.col("id")
    key = F.when(i % 17 == 0, None).when(i % 19 == 0, "").otherwise(F.concat(F.lit("k"), (i * 7919 % 1300).cast("string")))
    artist = F.when(i % 7 == 0, None).when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (i % 11).cast("string")))
    cat = spark.range(n).select(key.alias(KEY), F.concat(F.lit("t"), i % 5).alias("track_name"), artist.alias("artist_name"),
                                F.concat(F.lit("g"), i % 2).alias("genre"), (1950 + i % 60).cast("int").alias("year"),
                                (25_000 + i * 37 % 90_000).alias("duration_ms"))
    aud = spark.range(n).withColumn(KEY, F.when(i % 23 == 0, F.concat(F.lit("o"), i)).otherwise(key))
    aud = aud.withColumns({c: (i * 31 % 13 / F.lit(12.0)) for c in AUDIO_COLS}).withColumn("popularity", (i * 13 % 110).cast("int"))
    cast = lambda df, schema: df.select([F.col(f.name).cast(f.dataType) for f in schema.fields])        # noqa: E731
    return cast(cat, CATALOGUE), cast(aud, AUDIO)


@pytest.mark.parametrize("bucket_rows", [2_000_000, 20])
def test_landed_sources_give_the_rows_and_the_report_of_separate_checks(spark, monkeypatch, bucket_rows):
    cat, aud = odd_sources(spark)
    apart = silver.check_sources(cat, aud)
    monkeypatch.setattr(silver, "BUCKET_ROWS", bucket_rows)     # 20: every bucket is too full, the aggregates shuffle
    landed = silver.check_landed(cat, aud)
    unified, report = silver.write_unified(landed)
    assert rows(unified.table) == rows(silver.unify(apart)) == rows(unified.files) == rows(silver.unify(landed))
    assert unified.table.count() > 300
    assert report.collect() == silver.dq_report(apart).collect() == silver.dq_report(landed).collect()
    assert report.filter("rule = 'R6_key_in_catalogue'").first()["rejected"] > 0


def test_an_empty_day_is_reported_with_zeros(spark):
    cat, aud = (df.limit(0) for df in odd_sources(spark))
    unified, report = silver.write_unified(silver.check_landed(cat, aud))
    assert unified.table.count() == 0
    assert [(r["rows_in"], r["rejected"], r["rows_out"]) for r in report.collect()] == [(0, 0, 0)] * 8


def test_large_artists_are_read_file_by_file_with_the_same_lag(spark):
    unified, _ = silver.write_unified(silver.check_landed(*odd_sources(spark)))
    assert silver.artist_rows(unified, 3000) is unified.table
    assert silver.artist_rows(unified, 50) is unified.files
    plain = silver.enrich(silver.artist_rows(unified), checkpoint=False)
    cut = silver.enrich(silver.artist_rows(unified, 50), lag_window_max_rows=50, checkpoint=False)
    assert rows(plain) == rows(cut)


def test_the_silver_job_deals_no_row_by_key_or_artist_through_a_shuffle(spark, monkeypatch):
    cfg = JobConfig(raw_root=scratch_path(spark, "job-plans"), silver_db=scratch_database(spark), as_of="2024-06-30")
    land_raw(spark, wide_source(spark, SF_SMALL), cfg)
    plans = []
    for name in ("parquet", "saveAsTable"):
        def noted(self, *args, _write=getattr(DataFrameWriter, name), **kw):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return _write(self, *args, **kw)
        monkeypatch.setattr(DataFrameWriter, name, noted)
    build_silver(spark, cfg)
    assert any("Window" in p and "pop_prev_year" in p for p in plans)
    assert not [p for p in plans if "hashpartitioning(track_id" in p or "hashpartitioning(artist_name" in p]


def test_buckets_grow_with_the_rows_and_hold_all_rows_of_a_value(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [bucket_count(spark, n) for n in (0, 1, 100_000, 200_000_000)] == [1, 1, 1, max(cores, 100)]
    df = spark.range(1000).selectExpr("if(id % 5 = 0, null, concat('v', id % 40)) as v", "id")
    b = write_bucketed(df, "v", 4, ["v", "id"])
    assert rows(b.table) == rows(b.files) == rows(df)
    sizes = b.table.select(F.pmod(F.hash("v"), F.lit(4)).alias("b")).groupBy("b").count().collect()
    assert largest_bucket(df, "v", 4) == max(r["count"] for r in sizes)
    counted = b.table.groupBy("v").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString() and counted.count() == 33


def test_a_task_sorts_bounded_rows_when_sources_and_unified_rows_are_dealt(spark, monkeypatch):
    cat, aud = odd_sources(spark)
    apart = silver.check_sources(cat, aud)
    dealt = []

    def noted(df, by, buckets, *rest):
        dealt.append((by, buckets, *rest[1:]))
        return write_bucketed(df, by, buckets, *rest)
    monkeypatch.setattr(silver, "write_bucketed", noted)
    cores = spark.sparkContext.defaultParallelism
    assert bucket_count(spark, 216_000_000, silver.BUCKET_ROWS) == max(432, cores)
    assert bucket_count(spark, 216_000_000, silver.ARTIST_BUCKET_ROWS) == max(216, cores)
    monkeypatch.setattr(silver, "BUCKET_ROWS", 3000 / (2 * cores))
    monkeypatch.setattr(silver, "ARTIST_BUCKET_ROWS", 3000 / cores)
    monkeypatch.setattr(silver, "largest_bucket", lambda *_: 0)
    monkeypatch.setattr(bucketed, "DEAL_ROWS", 1000 / cores)
    unified, report = silver.write_unified(silver.check_landed(cat, aud))
    assert dealt == [(KEY, 2 * cores, 3), (KEY, 2 * cores, 3), ("artist_name", cores)]
    assert rows(unified.table) == rows(unified.files) == rows(silver.unify(apart))
    assert report.collect() == silver.dq_report(apart).collect()


def test_files_grow_with_the_rows_that_a_task_deals_and_not_with_splits(spark, monkeypatch):
    """Sources of many splits, and unified rows of many buckets, are dealt out by few tasks."""
    cat, aud = (df.repartition(40) for df in odd_sources(spark))
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(silver, "BUCKET_ROWS", 3000 / (3 * cores))
    monkeypatch.setattr(silver, "ARTIST_BUCKET_ROWS", 3000 / cores)
    monkeypatch.setattr(silver, "largest_bucket", lambda *_: 0)
    dealt = []
    monkeypatch.setattr(silver, "write_bucketed", lambda *a: dealt.append(write_bucketed(*a)) or dealt[-1])
    unified, report = silver.write_unified(silver.check_landed(cat, aud))
    tasks = [len({f.split("part-")[1][:5] for f in b.files.inputFiles()}) for b in dealt]
    assert len(dealt) == 3 and max(tasks) <= cores < 40
    apart = silver.check_sources(cat, aud)
    assert rows(unified.table) == rows(unified.files) == rows(silver.unify(apart))
    assert unified.rows == unified.files.count() > 300
    assert report.collect() == silver.dq_report(apart).collect()


@pytest.mark.parametrize("passes", [1, 3, 7])
def test_passes_write_each_row_once_and_no_more_files(spark, passes):
    df = spark.range(1000, numPartitions=2).selectExpr("if(id % 5 = 0, null, concat('v', id % 40)) as v", "id")
    b = write_bucketed(df, "v", 5, ["v", "id"], passes)
    assert rows(b.table) == rows(b.files) == rows(df)
    assert len(b.files.inputFiles()) == len(write_bucketed(df, "v", 5, ["v", "id"]).files.inputFiles())
    assert "Exchange" not in b.table.groupBy("v").count()._jdf.queryExecution().executedPlan().toString()
