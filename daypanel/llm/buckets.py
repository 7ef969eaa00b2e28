"""Packing into optimal length buckets.

Lengths are counted over the whole corpus.  Pieces are at most ``max_len`` words long, so the histogram has at most ``max_len + 1``
entries whatever the corpus, and the dynamic programme over it runs on the driver.  Batches form inside a bucket by place in a global
order, counted by partition, so no bucket is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm.frames import staged
from daypanel.operators.dims import assign_dense_ids

MAX_LEN = 2048
BUCKETS = 12
BUDGET = 16384
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words between white space: the default length of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0))


def boundaries(histogram: Mapping[int, int], buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` upper bounds that pad the pieces of the histogram (length -> count) as little as possible.

    Every piece goes to the smallest bound that holds it and is padded to it.  Of equally good choices, the one with the
    smaller lower bounds wins.  An empty histogram has no bounds.
    """
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    below = np.concatenate([[0], np.cumsum([histogram[x] for x in lengths.tolist()])]).astype(np.int64)
    m = len(lengths)
    # best[k]: least total size of the first k lengths with the buckets so far, the last of which ends at length k.
    best = below[1:] * lengths
    choice = [np.zeros(m, np.int64)]
    for _ in range(1, min(buckets, m)):
        cost = best[:, None] + (below[None, 1:] - below[1:, None]) * lengths[None, :]
        cost = np.where(np.tri(m, k=-1, dtype=bool).T, cost, np.iinfo(np.int64).max)  # an earlier bucket ends before
        before = np.argmin(cost, axis=0)
        split = cost[before, np.arange(m)]
        choice.append(np.where(split < best, before, -1))
        best = np.minimum(split, best)
    out, at = [], m - 1
    for chosen in reversed(choice[1:]):
        if chosen[at] >= 0:
            out.append(int(lengths[at]))
            at = int(chosen[at])
    return [*reversed([*out, int(lengths[at])])]


def padding(histogram: Mapping[int, int], bounds: list[int]) -> int:
    """Padded words in all, for given bounds."""
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def pack(docs: DataFrame, doc: str = "doc_id", length: Column | None = None, max_len: int = MAX_LEN, buckets: int = BUCKETS,
         budget: int = BUDGET) -> DataFrame:
    """``doc_id, piece, start_word, n_words, bucket, bucket_len, batch, slot``: one row per piece of a document.

    A document of more than ``max_len`` words is cut into pieces of ``max_len`` and a rest; nothing is dropped, and a document
    without words (null and empty texts) is one piece of length 0.  ``bucket_len`` is the length its bucket pads to; a batch holds
    ``budget // bucket_len`` pieces (one at least) of its bucket, in the order of document id and piece; only a bucket's last
    batch may hold fewer.  Repeated rows are pieces of their own.  An empty table packs to nothing.  Other columns are not read.

    length: how long a row is, a whole number column (default: words of ``text``).  Runs jobs.
    """
    n = (word_count() if length is None else length).cast("bigint")
    sized = docs.select(F.col(doc).alias("doc_id"), F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).alias("n"))
    last = F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / max_len).cast("int")
    pieces = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * max_len
    pieces = staged(pieces.select("doc_id", "piece", start.alias("start_word"),
                                  F.least(F.col("n") - start, F.lit(max_len)).cast("bigint").alias("n_words")), "pieces")
    counts = {r["n_words"]: r["n"] for r in pieces.groupBy("n_words").agg(F.count("*").alias("n")).collect()}  # max_len + 1 at most
    bounds = boundaries(counts, buckets)
    if not bounds:
        return pieces.select("doc_id", "piece", "start_word", "n_words", *[F.lit(0).cast(t).alias(c) for c, t in (
            ("bucket", "int"), ("bucket_len", "bigint"), ("batch", "bigint"), ("slot", "int"))])
    bucket, bound, size, first = F.lit(None), F.lit(None), F.lit(None), F.lit(None)
    for k in reversed(range(len(bounds))):
        inside = F.col("n_words") <= bounds[k]
        before = sum(c for x, c in counts.items() if k and x <= bounds[k - 1])
        bucket, bound, size, first = (F.when(inside, F.lit(v)).otherwise(old) for v, old in (
            (k, bucket), (bounds[k], bound), (max(1, budget // max(1, bounds[k])), size), (before, first)))
    placed = assign_dense_ids(pieces.withColumn("bucket", bucket.cast("int")), ["bucket", "doc_id", "piece"], "place")
    inside_bucket = F.col("place") - 1 - first.cast("bigint")
    return placed.select(
        "doc_id", "piece", "start_word", "n_words", "bucket", bound.cast("bigint").alias("bucket_len"),
        F.floor(inside_bucket / size).cast("bigint").alias("batch"), (inside_bucket % size).cast("int").alias("slot"))
