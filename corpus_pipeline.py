"""From raw documents to training batches: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes it as Parquet and reads it again as the next
stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daypanel.llm import buckets, golay, latent, line_dedup, rule_ledger
from daypanel.llm.frames import components, ship, staged, without


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the production policy."""
    ship(spark)
    rows = rule_ledger.ledger(docs.select(F.struct("*").alias("row"), "text"), carry=("row",))
    return rows.where(~rule_ledger.fails(rule_ledger.PRODUCTION)).select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; a text that changed gets its new length."""
    lines, dropped = _unused("lines", docs), _unused("dropped", docs)
    cut = line_dedup.drop_boilerplate(docs, counts=(lines, dropped))
    n_chars = F.when(F.col(dropped) > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cut.withColumn("n_chars", n_chars).drop(lines, dropped)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least id (none comes last), of those the first by a hash of the text.

    ``docs`` must come from files: a row is told apart by its file and its place there, so missing and repeated ids cost no text, and only
    the rows that go are sought, without moving the texts of those that stay.
    """
    def place() -> Column:
        meta = docs.metadataColumn("_metadata")
        return F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("line"))

    named = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), place().alias("place"))
    prints = staged(golay.fingerprints(named, carry=("place", "hash")), "row-fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "place"))
    best = staged(prints.groupBy("fp").agg(first.alias("best")), "best-rows")
    found = components(golay.links(best.select("fp")), best.select(F.col("fp").alias("node"), F.col("fp").alias("label")))
    grouped = best.join(found, F.col("fp") == F.col("node"), "left").select("fp", "best", F.coalesce("label", "fp").alias("group"))
    stay = staged(grouped.groupBy("group").agg(F.min("best").alias("best")).select("group", F.col("best.place").alias("stays")), "survivors")
    kept = grouped.select("fp", "group").join(stay, "group").select("fp", "stays")
    losers = staged(prints.join(kept, "fp").where(F.col("place") != F.col("stays")).select("place"), "losers")
    return without(docs, place(), losers)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item.  A leak is a matter of the text, so texts are searched by their hash, with or without an id."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    leaks = latent.contaminated(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, F.xxhash64("text"), staged(leaks.select("doc_id").distinct(), "leaking"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bucket and batch."""
    return buckets.pack(docs)


def _unused(name: str, docs: DataFrame) -> str:
    """``name``, with as many underscores in front as make it no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Fingerprints, a singular value decomposition and a dynamic programme have no counterpart in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
