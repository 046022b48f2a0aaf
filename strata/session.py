"""Session-scoped helpers: where intermediate data may be written."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file
    system such as HDFS or an object store). Only a local-mode session with no
    setting gets a folder of its own, so tests can run anywhere.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        sc.setCheckpointDir(root)  # so checkpoint() uses the folder the cluster names
        return (sc.getCheckpointDir() or root).rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder "
            "(HDFS / object store) before running strata jobs on a cluster"
        )
    root = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(root)
    return root


_SCRATCH: dict[str, list[str]] = {}          # per application: folders not released yet
_DATABASES: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the checkpoint root, released with the scope
    or session that asked for it."""
    path = f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_database(spark: SparkSession) -> str:
    """A fresh database in a scratch folder, dropped when scratch is released."""
    path = scratch_path(spark, "db")
    name = "strata_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{path}'")
    _DATABASES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, renamed into place, so that readers see the old one or the new one."""
    fs, target = hadoop_path(spark, path)
    _, draft = hadoop_path(spark, f"{path}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"cannot put {path} in place")


def read_text(spark: SparkSession, path: str) -> str:
    return "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def release_scratch(spark: SparkSession, keep: int = 0) -> None:
    """Delete scratch folders and databases, but for the first ``keep`` folders. Frames
    that read them cannot be used afterwards."""
    app = spark.sparkContext.applicationId
    paths, databases = _SCRATCH.get(app, []), _DATABASES.get(app, [])
    for name in [d for d in databases if not any(p.endswith(d.removeprefix("strata_")) for p in paths[:keep])]:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
        databases.remove(name)
    while len(paths) > keep:
        fs, p = hadoop_path(spark, paths.pop())
        fs.delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Releases at its end the scratch that was asked for inside it."""
    before = len(_SCRATCH.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release_scratch(spark, before)


def materialize(df: DataFrame) -> DataFrame:
    """Cut ``df``'s lineage: write it as Parquet in the shared checkpoint folder (never a
    local checkpoint) and read it back. Later actions and retried tasks re-read files,
    compressed and column-pruned, and the planner knows their bytes. This runs a job;
    the files stay until the scope or session releases its scratch."""
    spark = df.sparkSession
    path = scratch_path(spark, "materialized")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
