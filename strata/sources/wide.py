"""Multi-line CSV files read by many tasks.

A CSV file whose quoted fields hold newlines cannot be split by lines, because only the
text before a line tells whether it starts inside quotes; Spark's multi-line reader
therefore reads a file in one task. Here lines are read by splits, and the state is worked
out as a composition of small functions:

1. Every line maps the state it starts in (outside or inside a quoted field) to the state it
   ends in, by two regular expressions that follow the reader's rules for quotes. A map is a
   constant, the identity or a swap, and so is any run of lines.
2. A split is cut into blocks of at most ``BLOCK`` lines, so no window holds more than that.
   The lines are written once, in scratch buckets by block, where windows over line skeletons
   (file, block, place; no text) need no exchange: they give the map of
   all lines before a line; one row a block is then composed along its file, from outside.
3. Lines that start outside begin a record; lines that start inside belong to the last
   beginning, in an earlier block if need be. The records of a block are gathered from its
   bucket and written, and the lines are released; only the records that go on in a later block
   (one a block at most) are dealt again.
4. Records are parsed by ``from_csv``.

As in Spark's reader, the first line end of a file says whether its lines end with LF or CRLF;
in a CRLF file CRLF inside quotes becomes LF. A quote that is never closed takes the rest of its file into one record, there as here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import materialize, scratch_path, scratch_scope
from strata.sinks.bucketed import write_bucketed
from strata.sources.files import read_csv_wide

BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS        # lines
BUCKET_BYTES = 64 << 20        # a task sorts the lines of a bucket
FEW_BYTES = 4 << 20            # less is not worth a bucket of its own

# A quoted text up to its end, a whole field, and an opened field at the end of a line.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_QUOTED}"[^,]*+|[^",][^,]*+)?+'
_OPEN = rf'"{_QUOTED}$'
OPENS = rf'^(?:{_FIELD},)*+{_OPEN}'
STAYS_OPEN = rf'^{_QUOTED}(?:$|"[^,]*+,(?:{_FIELD},)*+{_OPEN})'


BLOCK_KEY = ["_file", "_start", "_block"]      # a block; a file's blocks are in the order of the last two


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Files with a number (a path in every row would fill the windows) and their length; no text is read."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_path"), "length")
    return materialize(files.withColumn("_file", F.row_number().over(Window.orderBy("_path"))))     # one row a file


def _lines(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Lines with their file, block (the split's start and a count) and place in the block, the
    state each ends in when it starts outside (``_out``) or inside (``_in``) a quoted field, and whether
    it ends with CR."""
    # One flag a line, not a backtracking search: lines without a quote keep their state.
    v = F.make_valid_utf8("value")
    quoted = F.contains("_line", F.lit('"'))
    return (spark.read.option("lineSep", "\n").text(path)
            .select(v.alias("_line"), F.col("_metadata.file_path").alias("_path"),
                    F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
            .join(files.select("_path", "_file"), "_path")
            .select("_line", "_file", "_start", F.shiftright("_at", BLOCK_BITS).alias("_block"), "_at",
                    (quoted & F.col("_line").rlike(OPENS)).alias("_out"),
                    (~quoted | F.col("_line").rlike(STAYS_OPEN)).alias("_in"), F.endswith("_line", F.lit("\r")).alias("_cr")))


def _composed(maps: DataFrame, by: list[str], *at: str) -> DataFrame:
    """``maps`` (``_out``, ``_in``) with the composition of all maps before each row of its group:
    ``_fixed`` (the state after them if it does not depend on where they start, else null)
    and ``_swapped``."""
    before = Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("_out") & ~F.col("_in")).cast("long")
    swaps = F.coalesce(F.sum(swap).over(before), F.lit(0))
    constant = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("state"), F.col("_swaps").alias("swaps")))
    out = maps.withColumn("_swaps", swaps).withColumn("_last", F.last(constant, ignorenulls=True).over(before))
    odd = lambda n: (n % 2) == 1                                                             # noqa: E731
    return out.withColumns({
        "_fixed": F.when(F.col("_last").isNotNull(), F.col("_last.state") != odd(F.col("_swaps") - F.col("_last.swaps"))),
        "_swapped": odd(F.col("_swaps"))}).drop("_swaps", "_last")


def _state(start: Column) -> Column:
    """The state before a row, from the state before its group."""
    return F.coalesce(F.col("_fixed"), start != F.col("_swapped"))


def _pieces(spark: SparkSession, path: str, pieces: str, going_on: str) -> None:
    """Writes the records of every block: lines of one begun in an earlier block have no ``_first``
    there, and ``going_on`` says for such a block where it began."""
    files = _files(spark, path)
    size, cores = files.agg(F.sum("length")).first()[0] or 0, spark.sparkContext.defaultParallelism
    buckets = max(1, min(cores, math.ceil(size / FEW_BYTES)), math.ceil(size / BUCKET_BYTES))
    lines = write_bucketed(_lines(spark, path, files), "_block", buckets).table
    first = lines.filter("_start = 0").groupBy("_file").agg(F.min(F.col("_at") * 2 + F.col("_cr").cast("long")).alias("_first"))
    files = first.select("_file", (F.col("_first") % 2 == 1).alias("_crlf"))
    skeleton = _composed(lines.drop("_line", "_cr"), BLOCK_KEY, "_at")
    after = F.struct(*[F.when(F.col(c), F.col("_in")).otherwise(F.col("_out")).alias(n)
                       for c, n in (("_from_out", "_out"), ("_from_in", "_in"))])
    ends = (skeleton.withColumns({"_from_out": _state(F.lit(False)), "_from_in": _state(F.lit(True))})
            .groupBy(*BLOCK_KEY).agg(F.max_by(after, "_at").alias("m")))
    starts = materialize(_composed(ends.select(*BLOCK_KEY, "m.*"), ["_file"], "_start", "_block")
                         .select(*BLOCK_KEY, _state(F.lit(False)).alias("_inside")).join(files, "_file"))
    upto = Window.partitionBy(*BLOCK_KEY).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.when(~_state(F.col("_inside")), F.col("_at"))
    unended = F.when(F.col("_crlf"), F.regexp_replace("_line", r"\r\z", "")).otherwise(F.col("_line"))
    (_composed(lines.drop("_cr"), BLOCK_KEY, "_at").join(starts, BLOCK_KEY)
     .withColumn("_first", F.last(begins, ignorenulls=True).over(upto))
     .groupBy(*BLOCK_KEY, "_first").agg(F.sort_array(F.collect_list(F.struct("_at", unended.alias("_line")))).alias("p"))
     .select(*BLOCK_KEY, "_first", F.array_join(F.transform("p", lambda x: x["_line"]), "\n").alias("record"))
     .write.option("compression", "zstd").parquet(pieces))
    earlier = Window.partitionBy("_file").orderBy("_start", "_block").rowsBetween(Window.unboundedPreceding, -1)
    begun = spark.read.parquet(pieces).groupBy(*BLOCK_KEY).agg(F.max("_first").alias("_last"))
    carried = F.last(F.when(F.col("_last").isNotNull(), F.struct("_start", "_block", "_last")), ignorenulls=True).over(earlier)
    (begun.join(starts, BLOCK_KEY).withColumn("_c", carried).filter("_inside")
     .select(*BLOCK_KEY, F.col("_c._start").alias("_r_start"), F.col("_c._block").alias("_r_block"), F.col("_c._last").alias("_r_at"))
     .write.parquet(going_on))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``_file`` (a number), ``_start``, ``_block``, ``_at`` (place of the first line) and ``record`` (its text)
    of every record of the CSV files at ``path``, headers included."""
    written = scratch_path(spark, "pieces"), scratch_path(spark, "going_on")      # outlive the lines
    with scratch_scope(spark):
        _pieces(spark, path, *written)
    pieces, going_on = (spark.read.parquet(p) for p in written)
    begun = ["_file", "_r_start", "_r_block", "_r_at"]
    heads = going_on.select("_file", *[F.col(a).alias(b) for a, b in zip(begun[1:], ["_start", "_block", "_first"])]).distinct()
    here = [*BLOCK_KEY, "_first"]
    # One row a block at most goes on, so the heads are written: their bytes are known to the joins.
    heads = materialize(heads)
    whole = (pieces.filter(F.col("_first").isNotNull()).join(heads, here, "left_anti")
             .select(*BLOCK_KEY, F.col("_first").alias("_at"), "record"))
    first = pieces.join(heads, here, "left_semi").select(
        "_file", *[F.col(b).alias(a) for a, b in zip(begun[1:], ["_start", "_block", "_first"])], "_start", "_block", "record")
    later = pieces.filter(F.col("_first").isNull()).join(going_on, BLOCK_KEY).select(*begun, "_start", "_block", "record")
    joined = (first.unionByName(later).groupBy(*begun)
              .agg(F.sort_array(F.collect_list(F.struct("_start", "_block", "record"))).alias("p"))
              .select("_file", F.col("_r_start").alias("_start"), F.col("_r_block").alias("_block"), F.col("_r_at").alias("_at"),
                      F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    return whole.unionByName(joined)


def read_csv_wide_parallel(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_csv_wide`` gives (all strings, columns of the header, quoted newlines and
    ``""`` legal, bad bytes replaced), with files split among tasks. The lines and
    the records are each written once; the result reads them."""
    names = read_csv_wide(spark, path).columns
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records(spark, path).filter(F.col("record") != "")
    heads = rows.groupBy(*BLOCK_KEY).agg(F.min("_at").alias("_at"))                        # one row a block
    header = materialize(heads.groupBy("_file").agg(F.min(F.struct("_start", "_block", "_at")).alias("h")).select("_file", "h.*"))
    parsed = F.from_csv("record", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    body = rows.join(header, [*BLOCK_KEY, "_at"], "left_anti").select(parsed.alias("r"))
    return body.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])
