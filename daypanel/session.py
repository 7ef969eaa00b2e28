"""Where intermediate data goes, and the strict session the ingest runs in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# For tables of some fifty columns.  A generated method beyond 8000 bytes of bytecode is never compiled by
# the JVM; below that limit Spark falls back to smaller methods that are, which is two to three times faster.
# And a task that may keep a file open per partition value need not sort all its rows by that value.
WIDE_TABLES = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.maxConcurrentOutputFileWriters": "100"}
_CHECKPOINT_DIR = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> None:
    """Set what suits wide tables in a session of one's own; the library changes no session it is given."""
    for key, value in WIDE_TABLES.items():
        spark.conf.set(key, value)


@contextmanager
def tuned(spark: SparkSession) -> Iterator[None]:
    """:func:`tune` for the length of a write, then as before."""
    before = {key: spark.conf.get(key) for key in WIDE_TABLES}
    tune(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local master without the setting gets a folder of its own; on a cluster a missing
    setting is an error, since a machine-local folder would lose data with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get(_CHECKPOINT_DIR, None) or context.getConf().get(_CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="daypanel-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/daypanel-{uuid.uuid4().hex}/{label}"


def durable(df: DataFrame) -> DataFrame:
    """``df`` as written by a reliable checkpoint: rows and their partitions no longer change.

    Runs a job.  A lost executor cannot make later stages see other rows or another order.
    """
    context, folder = df.sparkSession.sparkContext, shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def ingest_session(spark: SparkSession) -> SparkSession:
    """A sibling session in which text sources are read strictly.

    Header names must match in letter case, conversions raise instead of giving NULL, and lines are
    split into all their fields even when a query needs few of them, so that a row of wrong length
    cannot hide behind column pruning.  All other runtime settings are the caller's, whose session is
    left as it is.
    """
    strict = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if strict.conf.isModifiable(key):
            strict.conf.set(key, value)
    tune(strict)
    strict.conf.set("spark.sql.caseSensitive", "true")
    strict.conf.set("spark.sql.ansi.enabled", "true")
    strict.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    return strict
