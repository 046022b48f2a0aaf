import random

import pytest

from strata.sources.files import read_csv_wide
from strata.sources.wide import records, read_csv_wide_parallel


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def field(draw):
    plain = ["abc", "", "x y", "naïve", " lead", "tail ", "7", "é" * 5]
    quoted = ['"a,b"', '"say ""hi"""', '"one\ntwo"', '"\n\n"', '"line\r\nend"', '""', '""""', '"x,""y\n"",z"', '"' + "long\n" * 30 + '"', '",\n,"']
    return draw.choice(plain if draw.random() < 0.7 else quoted)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_splits_read_what_the_multi_line_reader_reads(spark, tmp_path, small_splits, seed, end):
    draw, header = random.Random(seed), '"c\nd"' if end == "\n" else '"c,d"'
    for f in range(2):
        body = end.join(",".join(field(draw) for _ in range(draw.choice([5, 5, 5, 3, 6]))) for _ in range(400))
        (tmp_path / f"f{f}.csv").write_bytes(f'"na,me",b,{header},d,e{end}{body}{end if f else ""}'.encode())
    want = rows(read_csv_wide(spark, str(tmp_path)))
    for n in (400, 1 << 27):
        small_splits(n)
        df = read_csv_wide_parallel(spark, str(tmp_path))
        assert df.columns == read_csv_wide(spark, str(tmp_path)).columns
        assert rows(df) == want
    assert len(want) > 700


def test_a_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    line = 'id,"two\nlines, ""quoted""",3\n'
    (tmp_path / "big.csv").write_text("a,b,c\n" + line * 20_000)
    small_splits(50_000)
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 8 and read_csv_wide(spark, str(tmp_path)).rdd.getNumPartitions() == 1
    got = read_csv_wide_parallel(spark, str(tmp_path))
    assert got.distinct().collect() == [("id", 'two\nlines, "quoted"', "3")] and got.count() == 20_000


def test_bad_bytes_stray_quotes_and_blank_lines(spark, tmp_path, small_splits):
    raw = (b'a,b,c\nx\xff,caf\xc3\xa9,\xe2\x82z\n\n5" vinyl,7" single,"12""\nin"\n"q"tail,1,2\n"broken \xfe\nrest",2,3\n,,\nlast,"end"')
    (tmp_path / "f.csv").write_bytes(raw)
    want = rows(read_csv_wide(spark, str(tmp_path)))
    for n in (7, 30):
        small_splits(n)
        assert rows(read_csv_wide_parallel(spark, str(tmp_path))) == want


def test_header_only_and_one_long_record(spark, tmp_path, small_splits):
    small_splits(50)
    (tmp_path / "h.csv").write_text("a,b\n")
    assert read_csv_wide_parallel(spark, str(tmp_path / "h.csv")).collect() == []
    (tmp_path / "l.csv").write_text('a,b\n1,"' + "x\n" * 500 + '"\n2,y\n')
    got = rows(read_csv_wide_parallel(spark, str(tmp_path / "l.csv")))
    assert got == [("1", "x\n" * 500), ("2", "y")]
    assert records(spark, str(tmp_path / "l.csv")).count() == 3


def test_texts_are_gathered_once_in_small_blocks(spark, tmp_path, small_splits, monkeypatch):
    """Blocks of four lines, records inside one, across two and across many of them; what is
    returned reads written records and deals no lines again."""
    from strata.sources import wide
    monkeypatch.setattr(wide, "BLOCK_BITS", 2)
    body = "".join(f'{i},"' + f"part {i}\n" * (i % 23) + f'end"\n' for i in range(300))
    for f in "ab":
        (tmp_path / f"{f}.csv").write_text("n,text\n" + body)
    want = rows(read_csv_wide(spark, str(tmp_path)))
    for n in (700, 1 << 27):
        small_splits(n)
        df = read_csv_wide_parallel(spark, str(tmp_path))
        assert "_line" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert rows(df) == want and len(want) == 600


def test_no_text_is_shuffled_and_the_lines_are_released(spark, tmp_path, small_splits, monkeypatch):
    """Lines are dealt in scratch buckets, one write; what stays are the records' texts."""
    from pyspark.sql import DataFrameWriter

    from strata import session
    body = "".join(f'{i},"' + f"part {i}\n" * (i % 5) + 'end"\n' for i in range(2000))
    for f in "ab":
        (tmp_path / f"{f}.csv").write_text("n,text\n" + body)
    want = rows(read_csv_wide(spark, str(tmp_path)))
    small_splits(9_000)
    plans = []
    for name in ("parquet", "saveAsTable"):
        def noted(self, *args, _write=getattr(DataFrameWriter, name), **kw):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return _write(self, *args, **kw)
        monkeypatch.setattr(DataFrameWriter, name, noted)
    session.scratch_path(spark, "before")
    before = len(session._SCRATCH[spark.sparkContext.applicationId])
    df = read_csv_wide_parallel(spark, str(tmp_path))
    texts = [p for p in plans if "_line" in p]
    assert texts and not [p for p in texts if "hashpartitioning" in p and "record" in p]
    kept = session._SCRATCH[spark.sparkContext.applicationId][before:]
    assert not [p for p in kept if "/bucketed-" in p] and [p for p in kept if "/pieces-" in p]
    assert rows(df) == want and len(want) == 4000
