"""Small DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import daypanel
from daypanel.session import durable, scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of all executors, once per application.

    The same as ``--py-files``, for sessions that were started without.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(daypanel.__file__).resolve().parent
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{root.name}", "zip", root.parent, root.name))
        _shipped.add(context.applicationId)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and read again.

    Cuts lineage like a checkpoint, and the planner then knows the size of the files.
    """
    path = scratch_path(df.sparkSession, f"{label}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(keys: DataFrame, n_bits: int) -> Column:
    """A scalar: array of ``n_bits`` bits in 64-bit numbers, set at the hashes of the one column of ``keys``; see :func:`marked`.

    Its size does not depend on the data, so it may go to every task.  As a filter before a join it keeps most rows without a partner out of the
    shuffle; with very many keys it lets more of them through, and the join decides anyway.
    """
    at = keys.select(_place(F.col(keys.columns[0]), n_bits).alias("at"))
    put = at.groupBy(F.floor(F.col("at") / 64).alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    dense = keys.sparkSession.range(n_bits // 64).join(put, "id", "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))  # n_bits / 64 entries
    return dense.agg(F.transform(listed, lambda x: x["bits"]).alias("bits")).scalar()


def marked(bits: Column, key: Column, n_bits: int) -> Column:
    """Whether the bitmap in ``bits`` may hold ``key``: always true of its keys, of others with a chance of keys / ``n_bits``."""
    at = _place(key, n_bits)
    return F.getbit(F.get(bits, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1


def _place(key: Column, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_bits))


def without(rows: DataFrame, key: Column, losers: DataFrame, n_bits: int = 1 << 22) -> DataFrame:
    """``rows`` but for those whose ``key`` is in the one column of ``losers``; columns of any name.

    The plan is the same at every size: rows that a bitmap of the losers clears stay where they are, and only the others, the losers and
    few besides, go through an exact anti join.  ``rows`` is read twice, ``losers`` several times, so it should be a stored table.  A null key is no loser.
    """
    named = rows.select(F.struct("*").alias("row"), key.alias("key")).withColumn("bits", bitmap(losers, n_bits))
    suspect = F.col("key").isNotNull() & marked(F.col("bits"), F.col("key"), n_bits)
    gone = losers.toDF("lost")
    stay = named.where(suspect).select("row", "key").join(gone, F.col("key") == F.col("lost"), "left_anti")
    return named.where(~suspect).select("row").unionAll(stay.select("row")).select("row.*")


def per_row(fn: Callable[..., tuple], names: list[str], schema: pa.Schema) -> Callable:
    """A function for ``mapInArrow`` that calls ``fn`` with the named columns of each row.

    Rows go through one record batch at a time, so memory is bounded by a batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            rows = [fn(*values) for values in zip(*(c.to_pylist() for c in columns), strict=True)]
            arrays = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, label``: the smallest label reachable from every node over undirected ``a, b`` edges.

    labels: ``node, label``, one row per node that occurs in an edge.  Every round hands the smallest label to the
    neighbours and then follows labels to their own label, so that chains shrink by a factor each round.  Rounds are
    cut by reliable checkpoints; the driver only sees how many nodes changed.  Ties between equal labels go to the
    smaller node.
    """
    both = staged(
        edges.where(F.col("a") != F.col("b"))
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b").distinct(), "edges")
    touched = both.select(F.col("a").alias("node")).distinct()
    # A label with the node it came from, so that it can be followed.
    at = durable(labels.join(touched, "node", "left_semi")
                 .select("node", F.struct(F.col("label").isNull(), F.col("label"), F.col("node")).alias("best")))
    while True:
        offered = both.join(at, both["a"] == at["node"]).select(F.col("b").alias("node"), "best")
        heard = (
            offered.unionByName(at).groupBy("node").agg(F.min("best").alias("best"))
            .join(at.select("node", F.col("best").alias("old")), "node")
        )
        heard = durable(heard)
        ahead = heard.select(F.col("node").alias("via"), F.col("best").alias("further"))
        jumped = durable(
            heard.join(ahead, F.col("best.node") == F.col("via"), "left")
            .select("node", F.least("best", "further").alias("best"), (F.col("best") != F.col("old")).alias("moved")))
        at = jumped.select("node", "best")
        if jumped.where("moved").limit(1).count() == 0:
            return at.select("node", F.col("best.label").alias("label"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
