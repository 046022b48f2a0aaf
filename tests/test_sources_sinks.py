import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.ingest import add_ingestion_partition, drop_partition_columns, parse_as_of
from strata.schemas import AUDIO
from strata.session import (
    checkpoint_root, materialize, path_exists, scratch_database, scratch_path, scratch_scope,
)
from strata.sinks.writers import (
    ensure_database, jdbc_write_options, write_csv, write_raw_parquet, write_table,
)
from strata.streaming import land_new_files
from strata.sources.files import ingest, read_csv_typed, read_csv_wide, read_raw_parquet, read_table


def test_wide_csv_quoting_newlines_and_bad_utf8(spark, tmp_path):
    p = tmp_path / "wide.csv"
    p.write_bytes(
        b'track_name,artist_name,genre,extra\n'
        b'"He said ""hi""","A, B","pop",1\n'
        b'"Two\nlines","C","rock",2\n'
        b'"Bad \xff byte","D","jazz",3\n'
        b'Short,E\n')
    df = read_csv_wide(spark, str(p))
    got = {r["track_name"]: r for r in df.collect()}
    assert 'He said "hi"' in got and got['He said "hi"']["artist_name"] == "A, B"
    assert "Two\nlines" in got
    assert "Bad � byte" in got
    assert got["Short"]["genre"] is None
    assert df.count() == 4


def test_typed_csv_permissive(spark, tmp_path):
    p = tmp_path / "audio.csv"
    header = ",".join(f.name for f in AUDIO.fields)
    good = "k1,0.5,0.5,1,-3.0,1,0.1,0.2,0.3,0.4,0.5,120.0,4,55"
    bad = "k2,0.5,0.5,x,-3.0,1,0.1,0.2,0.3,0.4,0.5,120.0,4,abc"
    short = "k3,0.5"
    p.write_text("\n".join([header, good, bad, short]) + "\n")
    out = {r["track_id"]: r for r in read_csv_typed(spark, str(p), AUDIO).collect()}
    assert out["k1"]["popularity"] == 55
    assert out["k2"]["key"] is None and out["k2"]["popularity"] is None
    assert out["k3"]["energy"] is None


def test_dynamic_overwrite_keeps_other_days(spark):
    path = scratch_path(spark, "test-raw")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_raw_parquet(add_ingestion_partition(df, "2024-01-01"), path, "append")
    write_raw_parquet(add_ingestion_partition(df, "2024-01-02"), path, "append")
    write_raw_parquet(add_ingestion_partition(df.filter("v = 2"), "2024-01-02"), path, "overwrite")
    back = read_raw_parquet(spark, path, drop_partitions=False)
    assert dict(back.dtypes)["ingestion_day"] == "int"
    counts = {r["ingestion_day"]: r["count"] for r in back.groupBy("ingestion_day").count().collect()}
    assert counts == {1: 2, 2: 1}
    one = read_raw_parquet(spark, path, as_of=dt.date(2024, 1, 1))
    assert one.count() == 2 and "ingestion_day" not in one.columns
    with pytest.raises(ValueError):
        write_raw_parquet(df, path, "upsert")


def test_ingestion_partition_parse_and_drop(spark):
    df = spark.createDataFrame([("a",)], "k string")
    out = add_ingestion_partition(df, "2023-02-28").collect()[0]
    assert (out["ingestion_year"], out["ingestion_month"], out["ingestion_day"]) == (2023, 2, 28)
    with pytest.raises(ValueError):
        parse_as_of("2023-02-30")
    assert drop_partition_columns(add_ingestion_partition(df, None)).columns == ["k"]
    assert drop_partition_columns(df) is df


def test_table_round_trip(spark):
    db = "strata_test_db"
    ensure_database(spark, db, scratch_path(spark, db))
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write_table(df, f"{db}.t", "overwrite")
    write_table(df, f"{db}.t", "append")
    assert read_table(spark, f"{db}.t").count() == 2
    write_table(df, f"{db}.t", "overwrite")
    assert read_table(spark, f"{db}.t").count() == 1


def test_ingest_dispatch_fails_before_work(spark):
    with pytest.raises(ValueError, match="unknown source"):
        ingest(spark, "tracks", {})
    with pytest.raises(ValueError, match="jdbc_url"):
        ingest(spark, "catalogue", {"jdbc_user": "u"})
    with pytest.raises(ValueError, match="input_path"):
        ingest(spark, "audio_features", {})


def test_checkpoint_root_uses_session_setting(spark):
    root = checkpoint_root(spark)
    assert root and spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_scope_releases_what_it_made(spark):
    before = scratch_path(spark, "outside")
    spark.range(3).write.parquet(before)
    with scratch_scope(spark):
        inside = materialize(spark.range(5)).inputFiles()[0].rsplit("/", 1)[0]
        db = scratch_database(spark)
        assert path_exists(spark, inside)
    assert not path_exists(spark, inside)
    assert db not in {d.name for d in spark.catalog.listDatabases()}
    assert spark.read.parquet(before).count() == 3


def test_batch_and_stream_never_share_a_folder(spark):
    landing, raw, ckpt = (scratch_path(spark, x) for x in ("landing", "raw", "ckpt"))
    audio = spark.createDataFrame([("k", 0.5)], "track_id string, danceability double")
    write_csv(audio, landing)
    day = add_ingestion_partition(audio, "2024-01-01")
    write_raw_parquet(day, raw, "append")
    with pytest.raises(ValueError, match="no stream wrote"):
        land_new_files(spark, landing, raw, ckpt, schema=audio.schema, as_of="2024-01-01")
    streamed = scratch_path(spark, "streamed")
    assert land_new_files(spark, landing, streamed, ckpt, schema=audio.schema, as_of="2024-01-01") == 1
    with pytest.raises(ValueError, match="belongs to a stream"):
        write_raw_parquet(day, streamed, "append")


def test_jdbc_write_options_are_those_given():
    assert jdbc_write_options("jdbc:x", "t", user="u") == {
        "url": "jdbc:x", "dbtable": "t", "truncate": True, "batchsize": 10_000, "user": "u"}


def test_raw_read_projects_to_declared_schema(spark):
    from pyspark.sql import functions as F
    from strata.schemas import CATALOGUE
    path = scratch_path(spark, "test-raw-extra")
    df = spark.createDataFrame([("k", "t", "a", "g", 2000, 40000)], CATALOGUE)
    write_raw_parquet(add_ingestion_partition(df.withColumn("created_at", F.current_timestamp()), "2024-01-01"),
                      path, "append")
    back = read_raw_parquet(spark, path, schema=CATALOGUE)
    assert back.columns == CATALOGUE.names
    assert "created_at" not in back._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
