import pytest
from pyspark.sql import functions as F

from strata.llm import cascade
from strata.session import materialize
from tests.llm.helpers import SF, edge_docs, empty_docs, write_tables
from tools.compare import compare_one, duck


def test_query_matches_oracle(spark):
    name = "op3_quality_cascade"
    res = compare_one(spark, duck(SF), name, SF, cascade.QUERIES, cascade.ORACLE)
    assert res["status"] == "ok", res


def test_edges_match_oracle(spark, tmp_path):
    folder = write_tables(spark, tmp_path, documents=edge_docs(spark, extra=True).coalesce(1))
    con = duck(folder)
    con.execute(f"CREATE VIEW d2 AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    sql = {"q": cascade.OP3_SQL.replace("from documents", "from d2")}
    res = compare_one(spark, con, "q", folder, {"q": cascade.op3_quality_cascade}, sql)
    assert res["status"] == "ok", res


def test_order_follows_gain_and_never_changes_the_verdict(spark):
    df = spark.range(1000)
    rare, common = cascade.Rule("rare", F.col("id") < 2), cascade.Rule("common", F.col("id") % 2 == 0)
    nothing = cascade.Rule("nothing", F.lit(None).cast("boolean"))
    found = cascade.estimate(df, [rare, nothing, common])
    assert {e.rule.name: round(e.rejected, 3) for e in found} == {"rare": 0.002, "common": 0.5, "nothing": 0.0}
    assert [e.gain for e in found] == sorted((e.gain for e in found), reverse=True)
    kept = lambda rules: {r["id"] for r in cascade.cascade(df, rules).filter("failed_rule IS NULL").collect()}
    assert kept([rare, common, nothing]) == kept([nothing, common, rare]) == {i for i in range(1000) if i % 2 and i > 1}


def test_empty_table(spark):
    assert cascade.cascade(cascade.measure(empty_docs(spark)), cascade.default_rules()).collect() == []
    assert [e.rejected for e in cascade.estimate(cascade.measure(empty_docs(spark)), cascade.default_rules())] == [0.0] * 5


def test_repeated_windows_are_counted_once_each(spark):
    eight = "a b c d e f g h"
    rows = [(1, f"{eight} x {eight}"), (2, "z " * 30), (3, eight)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in cascade.measure(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 16, 2: 30, 3: 0}


def test_branches_after_a_rejection_do_not_run(spark):
    """A costly rule, here one that fails when it is evaluated, is not touched by rows that an
    earlier rule or the base has rejected."""
    df = spark.range(100).select("id", (F.col("id") < 10).alias("base"))
    cheap = cascade.Rule("cheap", F.col("id") < 90)
    costly = cascade.Rule("costly", F.when(F.col("id") < 90, F.raise_error(F.lit("run"))).cast("boolean"))
    names = {r["failed_rule"]: r["n"] for r in cascade.cascade(df, [cheap, costly], given_up=F.col("base")).groupBy("failed_rule")
             .agg(F.count("*").alias("n")).collect()}
    assert names == {"cheap": 80, None: 20}
    with pytest.raises(Exception, match="run"):
        cascade.cascade(df, [costly, cheap], given_up=F.col("base")).collect()
    assert cascade.cascade(df.filter("base"), [costly], given_up=F.col("base")).filter("failed_rule is null").count() == 10


def test_measures_of_rules_stand_in_their_branches(spark):
    rules = cascade.default_rules()
    plan = cascade.cascade(cascade.measure(edge_docs(spark)), rules, given_up=F.col("base_failed"))
    assert not {"n_distinct_words", "capitals"} & set(plan.columns)


def test_estimates_are_stable(spark):
    sample = materialize(cascade.measure(spark.read.parquet(f"{SF}/documents.parquet").select("text")))
    orders = [[e.rule.name for e in cascade.estimate(sample.select(*sample.columns[1:], "text"), cascade.default_rules()) if e.rejected]
              for _ in range(3)]
    assert orders[0] == orders[1] == orders[2]
