"""Corpus preparation: the stages, in order, from ``documents`` to shards.

Every stage takes what its predecessor kept and returns it with the columns of
documents; the last adds ``curve``, ``shard`` and ``slot``. Extra columns travel along
whatever their names; columns named like the last stage's outputs are replaced by them.
An empty table passes through. Rows without text are never toxic, never near-duplicates
and never contaminated, and ask for no words, so the mix leaves them out, as it does
texts beyond their source's target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import curriculum, decontaminate, hilbert, minhash, toxicity
from strata.llm.common import free_name, read
from strata.session import scratch_path, scratch_scope

REJECT_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from ``labels``, does not call toxic."""
    score = free_name(docs, "score")
    lexicon = toxicity.trained(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, lexicon, name=score)
    return scored.filter(F.col(score) < REJECT_SCORE).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five-word shingles, 0.8)."""
    return minhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the curriculum takes, as often as it takes them, in training order."""
    packed = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row"))
    plan = curriculum.plan_mix(packed).select("doc_id", "_row", "positions")
    return curriculum.training_order(plan).select("_row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """40 shards of equal row counts along the Hilbert curve over language, source and size."""
    return hilbert.hilbert_shards(docs, hilbert.DIMS, hilbert.SHARDS, bits=hilbert.BITS, ties=["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned scores and MinHash groups are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet and read again as the next input."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)          # outlives what the stage itself writes
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
