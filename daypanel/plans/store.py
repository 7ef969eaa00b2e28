"""Stored tables: builds, the log of published builds, and reading them back.

A build writes its tables into a new folder; publishing adds one numbered commit to a log.  A commit is a file that is created
only if it is not there yet, so of two builds that start from the same commit one is published and the other raises, and no clock decides which
build is the latest.  Readers follow the log, so they see one build or another and nothing in between, and a failed build leaves no
trace in it.  Former builds stay readable by their number until :func:`expire` drops them.

The file system must create files exclusively, as HDFS and local ones do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daypanel.operators.quality import QualityError
from daypanel.plans.case_facts import DAY
from daypanel.plans.schemas import DELTA_TABLES, REPORTS, SCHEMAS
from daypanel.session import tuned

# Fixed value: version of the stored schema.
SCHEMA_VERSION = "2"

PARTITIONS = {"cdataset_raw": ["dataset"]}
_LOG = "commits"
_RUNNING = "running"


def new_build_id() -> str:
    return uuid.uuid4().hex


def table_path(root: str, build_id: str, name: str) -> str:
    return f"{root}/builds/{build_id}/{name}"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists",
                required: Sequence[str] = (), hidden: Sequence[str] = ()) -> DataFrame:
    """Write a table and return it as read back, without its ``hidden`` columns.  ``mode="append"`` adds rows to an existing table.

    required: columns that must not hold NULL.  They are counted while the rows pass by on their way
    to the files, and a NULL raises :class:`QualityError` after the write; the table is then there,
    but no caller goes on to publish it.
    """
    nulls = Observation()
    if required:
        df = df.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    with tuned(df.sparkSession):
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    found = {c: n for c, n in nulls.get.items() if n} if required else {}
    if found:
        raise QualityError(f"{path}: NULL in required column: {found}")
    return read_table(df.sparkSession, path, StructType([f for f in df.schema if f.name not in hidden]))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table; a known schema gives the column order and spares Spark reading a footer."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_meta(spark: SparkSession, path: str) -> DataFrame:
    """The build's ``field``/``value`` table with the schema version."""
    return write_table(spark.createDataFrame([("schemaver", SCHEMA_VERSION)], "field string, value string"), path)


class PublishConflict(RuntimeError):
    """Another build was published since this one began."""


def begin(spark: SparkSession, root: str) -> tuple[str, int]:
    """A new build's id and the number of the commit it follows (0: none); the build counts as running until it is published or given up."""
    build_id = new_build_id()
    _create(spark, f"{root}/{_RUNNING}/{build_id}", "")
    return build_id, max(commits(spark, root), default=0)


def give_up(spark: SparkSession, root: str, build_id: str) -> None:
    """The build will not be published: its folder is no longer needed."""
    _remove(spark, f"{root}/{_RUNNING}/{build_id}")


def publish(spark: SparkSession, root: str, build_id: str, follows: int | None = None) -> int:
    """Make the build the published one; returns its commit's number.

    follows: the commit the build began from (default: the latest).  Raises :class:`PublishConflict` if that number has a successor already.
    """
    number = (max(commits(spark, root), default=0) if follows is None else follows) + 1
    if not _create(spark, f"{root}/{_LOG}/{number:012d}", build_id):
        raise PublishConflict(f"{root}: commit {number} was published by another build")
    _remove(spark, f"{root}/{_RUNNING}/{build_id}")
    return number


def commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all published builds that are still there, in order."""
    return sorted(int(name) for name in _names(spark, f"{root}/{_LOG}"))


def published_build(spark: SparkSession, root: str, number: int | None = None) -> str:
    """Id of the build published last, or as the given commit."""
    known = commits(spark, root)
    if not known or (number is not None and number not in known):
        raise LookupError(f"{root}: no published build" + ("" if number is None else f" {number}"))
    return _text(spark, f"{root}/{_LOG}/{known[-1] if number is None else number:012d}")


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Drop all commits but the last ``keep`` and the folders that no kept commit and no running build refers to; returns the builds dropped.

    Readers of a dropped build fail from then on.
    """
    if keep < 1:
        raise ValueError("the published build cannot be dropped")
    known = commits(spark, root)
    for number in known[:-keep]:
        _remove(spark, f"{root}/{_LOG}/{number:012d}")
    used = {published_build(spark, root, n) for n in known[-keep:]} | set(_names(spark, f"{root}/{_RUNNING}"))
    unused = sorted(set(_names(spark, f"{root}/builds")) - used)
    for build_id in unused:
        _remove(spark, f"{root}/builds/{build_id}")
    return unused


def open_tables(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The stored tables of the build published last, or as the given commit."""
    build_id = published_build(spark, root, number)
    return {name: read_table(spark, table_path(root, build_id, name), schema) for name, schema in SCHEMAS.items()}


def open_dated(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The same, panels with the text columns ``date`` and, where deltas are taken, ``date_next``, which files are pruned by."""
    build_id = published_build(spark, root, number)
    return {name: read_table(spark, table_path(root, build_id, name), dated_schema(name)) for name in SCHEMAS}


def dated_schema(name: str) -> StructType:
    schema = SCHEMAS[name]
    if DAY not in schema.names:
        return schema
    texts = ["date", *(["date_next"] if name in DELTA_TABLES else [])]
    return StructType([*schema.fields, *[StructField(c, StringType()) for c in texts]])


def open_report(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """``build_report`` and ``rejects`` of a published build."""
    build_id = published_build(spark, root, number)
    return {name: read_table(spark, table_path(root, build_id, name), schema) for name, schema in REPORTS.items()}


def write_bucketed(df: DataFrame, table: str, path: str, entity: Sequence[str], day: str, buckets: int) -> DataFrame:
    """``df`` as a catalog table in ``buckets`` buckets by entity, sorted by entity and day.

    Windows by the entity, deltas and gap filling among them, then need no shuffle.  Each bucket is one file, so there should be several per core.
    """
    with tuned(df.sparkSession):
        (df.repartition(buckets, *entity).write.format("parquet").option("path", path)
         .bucketBy(buckets, *entity).sortBy(*entity, day).saveAsTable(table))
    return df.sparkSession.table(table)


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """A new file with the text; False if there is one of that name."""
    files, at = _path(spark, path)
    try:
        out = files.create(at, False)
    except Py4JJavaError as e:
        if files.exists(at):
            return False
        raise e
    out.write(text.encode())
    out.close()
    return True


def _text(spark: SparkSession, path: str) -> str:
    files, at = _path(spark, path)
    opened = files.open(at)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, at = _path(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


def _remove(spark: SparkSession, path: str) -> None:
    files, at = _path(spark, path)
    files.delete(at, True)
