"""Language-model scoring with Stupid Backoff, as joins between n-gram counts and the n-grams of documents.

score(w | context) is count(context w) / count(context) if that n-gram was seen at least ``min_count`` times, else ``alpha`` times the score
with a shorter context; single words end the chain with count(w) / total.  A document's score sums the logarithms.

How the rows travel.  Documents are dealt into buckets of a few megabytes.  A bucket's n-grams (orders 1 to ``order``) are counted
inside the bucket first, so the commonest n-gram costs a bucket one entry, and go out as sorted hashes, one row per slice of
the hash range.  A slice of the count table gathers its entries from all buckets, sums them, and answers each bucket with the
global counts in the order asked.  A bucket joins the answers with its documents again.  What a task holds is one bucket or one
slice; the number of both follows the size of the corpus.  N-grams are told apart by hashes whose width follows the number of
characters, up to 64 bits, so that an n-gram shares its hash with another one with a chance of less than 2**-16 at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daypanel.llm import tokens
from daypanel.session import durable

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 2
BUCKET_CHARS = 6_000_000
SLICE_CHARS = 16_000_000
_SPARE_BITS = 16


def score(docs: DataFrame, doc: str = "doc_id", text: str = "text", order: int = ORDER, alpha: float = ALPHA,
          min_count: int = MIN_COUNT, bucket_chars: int = BUCKET_CHARS, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score``: one row per row of ``docs``, natural logarithms.

    Counts are those of all rows, repeated rows included; words are white-space separated, A-Z in lower case.  ``min_count`` holds
    for n-grams of two words and more.  A position with fewer words before it starts at a lower order, without ``alpha``.
    A null or empty text scores 0 with a null mean.  Other columns are not read.  Runs jobs.
    """
    chars = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("n")).first()["n"]
    buckets = max(8, math.ceil(chars / bucket_chars))
    slice_bits = max(3, math.ceil(math.log2(max(1, chars / slice_chars))))
    bits = min(64, max(1, chars).bit_length() + _SPARE_BITS)
    dealt = (
        docs.select(docs[doc].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("body"))
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "body"), F.lit(buckets)).cast("int"))
        .repartition(buckets, "bucket")
    )
    asked = dealt.groupBy("bucket").applyInArrow(
        _ask(order, bits, slice_bits), "bucket int, size int, slice int, hashes binary, counts binary")
    answered = asked.groupBy("size", "slice").applyInArrow(_answer(min_count), "bucket int, size int, slice int, counts binary")
    scored = dealt.groupBy("bucket").cogroup(answered.groupBy("bucket")).applyInArrow(
        _score(order, bits, math.log(alpha)), "doc_id bigint, n_words bigint, partial double, single bigint")
    rows = durable(scored)
    total = rows.agg(F.greatest(F.sum("n_words"), F.lit(1))).scalar()
    log_score = F.col("partial") - F.when(F.col("single") > 0, F.col("single") * F.log(total.cast("double"))).otherwise(0.0)
    return rows.select("doc_id", "n_words", log_score.alias("log_score"),
                       F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"))


def _grams(table: pa.Table, order: int, bits: int) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each chunk of texts: its first row, and per order the n-gram hashes and their bounds per text."""
    texts = table.column("body").combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    for words in tokens.word_chunks(texts, tokens.BETWEEN_SPACES):
        grams = [tokens.ngrams(words, n) for n in range(1, order + 1)]
        yield words.first, [(hashes >> np.uint64(64 - bits), bounds) for hashes, bounds in grams]


def _all_hashes(table: pa.Table, order: int, bits: int) -> list[np.ndarray]:
    """Per order all n-gram hashes of a bucket, as they come."""
    parts: list[list[np.ndarray]] = [[] for _ in range(order)]
    for _, grams in _grams(table, order, bits):
        for k, (hashes, _) in enumerate(grams):
            parts[k].append(hashes)
    return [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]


def _packed(sorted_hashes: np.ndarray) -> bytes:
    """The first hash, then gaps of as few bytes as hold them all."""
    gaps = np.diff(sorted_hashes)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    raw = np.ascontiguousarray(gaps.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return sorted_hashes[:1].astype("<u8").tobytes() + bytes([width]) + raw[:, :width].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[8]
    body = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    raw = np.zeros((len(body), 8), np.uint8)
    raw[:, :width] = body
    out = np.empty(len(body) + 1, np.uint64)
    out[0] = np.frombuffer(data, "<u8", 1)[0]
    out[1:] = raw.view("<u8").reshape(-1)
    return np.cumsum(out, dtype=np.uint64)


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them all, which stands in front."""
    kind = next(k for k in ("u1", "u2", "u4", "u8") if not len(values) or int(values.max()) < 1 << (8 * int(k[1])))
    return kind[1].encode() + values.astype("<" + kind).tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[:1].decode()}", offset=1).astype(np.int64)


def _ask(order: int, bits: int, slice_bits: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        rows: list[tuple] = []
        for k, hashes in enumerate(_all_hashes(table, order, bits)):
            unique, counts = np.unique(hashes, return_counts=True)
            cuts = np.searchsorted(unique >> np.uint64(bits - slice_bits), np.arange((1 << slice_bits) + 1, dtype=np.uint64))
            rows += [(bucket, k + 1, s, _packed(unique[a:b]), _small(counts[a:b]))
                     for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if a < b]
        return _table(rows, [("bucket", pa.int32()), ("size", pa.int32()), ("slice", pa.int32()), ("hashes", pa.binary()),
                             ("counts", pa.binary())])

    return run


def _answer(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        asked = [_unpacked(x.as_buffer().to_pybytes()) for x in table.column("hashes")]
        counts = np.concatenate([_large(x.as_buffer().to_pybytes()) for x in table.column("counts")])
        size, part = table.column("size")[0].as_py(), table.column("slice")[0].as_py()
        unique, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)
        if size > 1:
            total[total < min_count] = 0
        answers, at, rows = total[place], 0, []
        for bucket, hashes in zip(table.column("bucket").to_pylist(), asked, strict=True):
            rows.append((bucket, size, part, _small(answers[at:at + len(hashes)])))
            at += len(hashes)
        return _table(rows, [("bucket", pa.int32()), ("size", pa.int32()), ("slice", pa.int32()), ("counts", pa.binary())])

    return run


def _score(order: int, bits: int, log_alpha: float):
    schema = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("partial", pa.float64()), ("single", pa.int64())]

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _table([], schema)
        ids, rows = docs.column("doc_id").to_pylist(), [(0, 0.0, 0)] * len(docs)
        replies = sorted(zip(answers.column("size").to_pylist(), answers.column("slice").to_pylist(), range(len(answers)), strict=True))
        known = []
        for k, hashes in enumerate(_all_hashes(docs, order, bits)):
            mine = [_large(answers.column("counts")[i].as_buffer().to_pybytes()) for size, _, i in replies if size == k + 1]
            known.append((np.unique(hashes), np.concatenate(mine) if mine else np.zeros(0, np.int64)))
        for first, grams in _grams(docs, order, bits):
            counts = [c[np.searchsorted(u, g)] if len(g) else np.zeros(0, np.int64) for (g, _), (u, c) in zip(grams, known, strict=True)]
            for k in range(len(grams[0][1]) - 1):
                mine = [c[b[k]:b[k + 1]] for c, (_, b) in zip(counts, grams, strict=True)]
                rows[first + k] = _one(mine, log_alpha)
        return _table([(i, *r) for i, r in zip(ids, rows, strict=True)], schema)

    return run


def _one(counts: list[np.ndarray], log_alpha: float) -> tuple[int, float, int]:
    """Words, the score without the total of all words, and how many positions ended at single words.

    ``counts[n - 1][i]``: the count of the n-gram that begins at word ``i``, 0 if it is too rare.
    """
    n = len(counts[0])
    if not n:
        return 0, 0.0, 0
    logs = np.log(counts[0].astype(float))  # level 1: count(w), divided by the total later
    level = np.ones(n, np.int64)
    longest = np.minimum(np.arange(1, n + 1), len(counts))
    for size in range(2, len(counts) + 1):
        if n < size:
            break
        seen = counts[size - 1]
        hit = np.flatnonzero(seen > 0)
        logs[hit + size - 1] = np.log(seen[hit]) - np.log(counts[size - 2][hit])
        level[hit + size - 1] = size
    return n, float(logs.sum() + log_alpha * (longest - level).sum()), int((level == 1).sum())


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(schema)], schema=pa.schema(schema))
