"""Shared scratch storage for intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Folder the cluster names for checkpoints.

    Executors on other machines must see it, so a machine-local folder is made
    only when the session runs in local mode and names none.
    """
    context = spark.sparkContext
    root = context.getConf().get(SETTING) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Folders settled in each of the scopes that are open, the innermost one last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end, also after an error, the tables that were settled inside.

    Tables settled with ``keep`` stay; if there is an enclosing scope, they are
    deleted at its end. Nothing that leaves the scope may still read a table
    that does not. Without any scope, tables stay in the scratch folder.
    """
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Whether Spark removes the shuffle files of an execution at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    The result no longer depends on how its rows were computed: a lost executor
    re-reads files instead of re-running (and perhaps re-splitting) the input.
    The shuffle files that led to it are of no more use and removed at once.
    Within a ``scratch_scope`` the table lives until its end, with ``keep`` longer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    scopes = _SCOPES.get()[: -1 if keep else None]
    if scopes:
        scopes[-1].append(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
