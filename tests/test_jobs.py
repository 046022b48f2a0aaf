"""End-to-end jobs on sf0.001: land -> silver -> gold, plus layer invariants."""

from pyspark.sql import functions as F

from strata.operators.conform import key_violations
from strata.plans.jobs import JobConfig, run
from strata.schemas import GOLD_KEYS
from strata.session import scratch_path
from strata.sources.fixtures import wide_source
from tests.conftest import SF_SMALL


def test_pipeline_end_to_end(spark):
    root = scratch_path(spark, "job")
    cfg = JobConfig(raw_root=f"{root}/raw", silver_db="strata_job_silver", gold_db="strata_job_gold",
                    silver_location=f"{root}/silver", gold_location=f"{root}/gold", as_of="2024-06-30")
    report = run(spark, wide_source(spark, SF_SMALL), cfg).collect()
    assert cfg.counts["raw.catalogue"] == cfg.counts["raw.audio_features"] == 6000
    assert cfg.counts["strata_job_silver.tracks_unified"] == 1665
    assert cfg.counts["strata_job_silver.genre_stats"] == 42
    assert cfg.counts["strata_job_silver.artist_stats"] == 20
    assert cfg.counts["strata_job_gold.dm_genre_trends"] == 12
    assert cfg.counts["strata_job_gold.dm_top_artists"] == 20
    assert cfg.counts["strata_job_gold.dm_hits_emergents"] == 414
    assert len(report) == 8
    silver = spark.table("strata_job_silver.tracks_unified")
    assert silver.select("track_id").distinct().count() == silver.count()
    for name, keys in GOLD_KEYS.items():
        mart = spark.table(f"strata_job_gold.{name}")
        assert key_violations(mart, keys).count() == 0, name
    hits = spark.table("strata_job_gold.dm_hits_emergents")
    assert hits.filter(F.col("rank_in_year") > 10).count() == 0
    assert dict(hits.dtypes)["danceability"] == "decimal(6,4)"


def test_results_do_not_depend_on_partitioning(spark):
    from strata.plans import gold, silver
    from strata.registry import sources

    def marts(n):
        cat, aud = sources(spark, SF_SMALL)
        s = silver.with_scalars(silver.unify(silver.check_sources(cat.repartition(n), aud.repartition(n))))
        return (sorted(gold.dm_top_artists(s, "2024-01-01").collect()),
                sorted(silver.genre_stats(s).collect()))

    base = marts(1)
    for n in (7, 64):
        assert marts(n) == base


def test_landing_rerun_replaces_only_its_day(spark):
    from strata.plans.jobs import land_raw
    from strata.sources.files import read_raw_parquet
    root = scratch_path(spark, "job-rerun")
    wide = wide_source(spark, SF_SMALL)
    for day in ("2024-06-29", "2024-06-30", "2024-06-30"):   # the last run is a restart
        land_raw(spark, wide, JobConfig(raw_root=root, as_of=day))
    back = read_raw_parquet(spark, f"{root}/audio_features", drop_partitions=False)
    days = {r["ingestion_day"]: r["count"] for r in back.groupBy("ingestion_day").count().collect()}
    assert days == {29: 6000, 30: 6000}


def test_appended_runs_append_their_own_statistics(spark):
    from strata.plans.jobs import build_silver, land_raw
    from strata.session import scratch_database
    cfg = JobConfig(raw_root=scratch_path(spark, "job-append"), silver_db=scratch_database(spark),
                    as_of="2024-06-30", table_mode="append")
    land_raw(spark, wide_source(spark, SF_SMALL), cfg)
    for _ in range(2):
        build_silver(spark, cfg)
    assert spark.table(f"{cfg.silver_db}.tracks_unified").count() == 3330
    for name, column in (("genre_stats", "nb_tracks"), ("artist_stats", "total_tracks")):
        assert spark.table(f"{cfg.silver_db}.{name}").agg(F.sum(column)).first()[0] == 3330


def test_a_mart_with_a_repeated_key_is_refused(spark):
    import pytest
    from strata.plans.jobs import require_keys
    mart = spark.createDataFrame([("a",), ("a",)], "track_id string")
    with pytest.raises(ValueError, match="track_id"):
        require_keys(mart, "dm_track_popularity")


def test_jobs_leave_no_scratch(spark):
    from strata.plans.jobs import land_raw
    from strata.session import hadoop_path
    root = scratch_path(spark, "job-clean")
    folder = root.rsplit("/", 1)[0]
    fs, p = hadoop_path(spark, folder)
    before = {str(f.getPath()) for f in fs.listStatus(p)} if fs.exists(p) else set()
    land_raw(spark, wide_source(spark, SF_SMALL), JobConfig(raw_root=root, as_of="2024-06-30"))
    after = {str(f.getPath()) for f in fs.listStatus(p)}
    assert {x.rsplit("/", 1)[-1] for x in after - before} == {root.rsplit("/", 1)[-1]}


def test_rows_without_a_key_are_counted_and_refused(spark):
    import pytest
    from strata.plans.jobs import without_null_keys
    mart = spark.createDataFrame([("a", 1990), (None, 1990), ("b", None), ("c", 2000)], "genre string, decade int")
    cfg = JobConfig(raw_root="unused", max_null_key_share=0.5)
    kept = without_null_keys(mart, "dm_genre_trends", cfg)
    assert [r["genre"] for r in kept.collect()] == ["a", "c"] and cfg.counts["dm_genre_trends.null_keys"] == 2
    cfg.max_null_key_share = 0.4
    with pytest.raises(ValueError, match="2 of 4 rows"):
        without_null_keys(mart, "dm_genre_trends", cfg)


def test_texts_beyond_their_declared_length_are_refused_or_cut(spark):
    import pytest
    from strata.operators.conform import conform
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("genre", StringType())])
    df = spark.createDataFrame([("é" * 100,), (None,), ("x" * 101,)], schema)
    assert conform(df.limit(2), schema, lengths={"genre": 100}).count() == 2
    with pytest.raises(Exception, match="101 characters, at most 100"):
        conform(df, schema, lengths={"genre": 100}).collect()
    assert [len(r[0] or "") for r in conform(df, schema, strict=False, lengths={"genre": 100}).collect()] == [100, 0, 100]


def test_runs_are_all_or_nothing_and_repeatable(spark):
    import pytest
    from strata.sinks.runs import RunStore
    store = RunStore(spark, scratch_path(spark, "runs"))
    two = lambda n: [(spark.range(n), "a"), (spark.range(2 * n).selectExpr("id", "'x' as s"), "b")]      # noqa: E731

    def write(name, n, upto=2, **options):
        run = store.begin(name)
        for df, table in two(n)[:upto]:
            run.write(df, table)
        if upto == 2:
            run.commit(**options)

    sizes = lambda: (store.read("a").count(), store.read("b").count())                                  # noqa: E731
    with pytest.raises(ValueError):
        store.read("a")
    write("r1", 3)
    write("r2", 50, upto=1)                       # dies between its tables
    assert sizes() == (3, 6) and store.runs == ["r1"]
    write("r2", 5)
    write("r2", 5)                                # repeated after it was committed
    assert sizes() == (8, 16) and store.runs == ["r1", "r2"]
    write("r1", 4)
    assert sizes() == (9, 18) and store.read("b").columns == ["id", "s"]
    write("new", 1, replace=True)
    assert sizes() == (1, 2) and store.runs == ["new"]
    with pytest.raises(ValueError):
        store.begin("a/b")


def test_a_silver_job_killed_between_its_statistics_equals_a_clean_one(spark, monkeypatch):
    import pytest
    from strata.plans import silver
    from strata.plans.jobs import build_gold, build_silver, land_raw, silver_table
    from strata.sinks.runs import RunStore
    from strata.session import scratch_database
    cfg = JobConfig(raw_root=scratch_path(spark, "job-runs"), silver_root=scratch_path(spark, "job-silver"), gold_db=scratch_database(spark),
                    as_of="2024-06-30", table_mode="append")
    land_raw(spark, wide_source(spark, SF_SMALL), cfg)

    def die(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(silver, "artist_stats", die)
        with pytest.raises(OSError):
            build_silver(spark, cfg)
    assert RunStore(spark, cfg.silver_root).runs == []
    for _ in range(2):
        assert build_silver(spark, cfg).count() == 8
    assert RunStore(spark, cfg.silver_root).runs == ["2024-06-30"]
    for name, column in (("genre_stats", "nb_tracks"), ("artist_stats", "total_tracks")):
        assert silver_table(spark, name, cfg).agg(F.sum(column)).first()[0] == 1665
    build_gold(spark, cfg)
    assert spark.table(f"{cfg.gold_db}.dm_hits_emergents").count() == 414
