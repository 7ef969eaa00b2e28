"""SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprints link if they differ in at most two bits.  A fingerprint is cut into three segments.  With two errors at most, one
segment is free of errors (pigeonhole), and the segment after it holds two at most.  The perfect Golay code (23, 12, 7)
decodes every 23-bit word; the words one flip away decode to one or six codewords in all, and two words at most two flips apart
share one of these, namely the codeword of a word between them.  So a key is (exact segment, one codeword of the next), a
fingerprint has three to eighteen of them, and linked fingerprints share a key without fail.

Hot keys.  Keys hold distinct fingerprints, so copies never meet there.  In keys of up to ``PAIRED`` fingerprints all pairs are
verified.  Fingerprints of larger keys go through an exact way of linear size: each is sent to the 65 words at distance one or
less, and two fingerprints meet at one of these exactly if they differ in two bits or less; those that meet are linked in a star.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.llm.frames import components, staged

SHINGLE = 3
MAX_BITS = 2
PAIRED = 32
_SEED = 42
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_GENERATOR = 0xC75
#: Lowest bit and width of each segment.
_SEGMENTS = ((0, 22), (22, 21), (43, 21))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, _SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    h = [digest(line[a:b], _SEED) for a, b in zip(begins, ends[shingle - 1:].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        part = np.array(h[k:k + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > len(h)).tolist())


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp``: one row per row of ``docs``; ``fp`` holds the 64 bits as a signed number.  Columns ``carry`` follow as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column("body").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64)), *[batch.column(c) for c in carry]],
                                             ["doc_id", "fp", *carry])

    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(docs[doc].alias("doc_id"), docs[text].alias("body"), *[docs[c] for c in carry]).mapInArrow(
        run, f"doc_id bigint, fp bigint{carried}")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest document id reachable over links of at most ``max_bits`` (0 to 2) differing bits, the row's
    own id included; a null id counts only where a component has no other.  Null and empty texts have the fingerprint zero and
    link like any other.  Repeated rows stay.  Other columns are not read.  Runs jobs.
    """
    rows = staged(fingerprints(docs, doc, text, shingle), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes.select("fp"), max_bits), classes.select(F.col("fp").alias("node"), F.col("least").alias("label")))
    named = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("label")).alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a, b`` whose components are those of all links between the distinct fingerprints ``fp``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys find fingerprints of at most two differing bits")
    keyed = distinct.mapInArrow(_keys, "key bigint, fp bigint")
    sized = staged(keyed.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1"), "keys")
    groups = sized.where(F.col("n") <= PAIRED).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # PAIRED at most

    def after(x: Column, at: Column) -> Column:
        others = F.filter("fps", lambda y, k: (k > at) & (F.bit_count(x.bitwiseXOR(y)) <= max_bits))
        return F.transform(others, lambda y: F.struct(x.alias("a"), y.alias("b")))

    paired = groups.select(F.inline(F.flatten(F.transform("fps", after))))
    return paired.unionByName(_crowded(sized.where(F.col("n") > PAIRED).select("fp").distinct(), max_bits)).distinct()


def _crowded(fps: DataFrame, max_bits: int) -> DataFrame:
    """Star edges among fingerprints that meet at a word one flip away (max_bits 2), or are one flip apart."""
    flips = [F.lit(0)] if max_bits == 0 else [F.lit(0), *[F.lit(-(1 << 63) if k == 63 else 1 << k) for k in range(64)]]
    spread = fps.select("fp", F.explode(F.array(*[f.cast("bigint") for f in flips])).alias("flip"))
    at = spread.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("place"), (F.col("flip") == 0).alias("own"))
    place = Window.partitionBy("place")
    if max_bits == 2:
        star = at.withColumn("hub", F.min("fp").over(place))
    else:  # only with the word that stands there itself
        star = at.withColumn("hub", F.max(F.when(F.col("own"), F.col("fp"))).over(place))
    return star.where(F.col("hub").isNotNull() & (F.col("hub") != F.col("fp"))).select(F.col("hub").alias("a"), F.col("fp").alias("b"))


@lru_cache
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and for every syndrome the error patterns to its codewords.

    The pattern of weight three or less (one for each syndrome), and, if that has weight three, those of weight four.
    """
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= _GENERATOR << (bit - 11)
        return word

    single = [remainder(1 << k) for k in range(23)]
    patterns: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(23), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= single[b]
            near = patterns.setdefault(syndrome, [])
            if weight < 4 or near[0].bit_count() == 3:
                near.append(sum(1 << b for b in bits))
    errors = np.array([(patterns[s] * 6)[:6] for s in range(2048)], np.int64)
    low = np.array([remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], np.int64)
    return low, high, errors


def codewords(words: np.ndarray) -> np.ndarray:
    """Six 12-bit codeword indices for each 23-bit word; a word near its codeword repeats that one."""
    low, high, errors = _code()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ errors[syndrome]) >> 11  # twelve bits tell a codeword


def keys_of(fps: np.ndarray) -> np.ndarray:
    """Eighteen keys per fingerprint (unsigned), repeated where codewords are."""
    segments = [((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in _SEGMENTS]
    out = [np.int64(s << 40) | (segments[s][:, None] << 12) | codewords(segments[(s + 1) % 3]) for s in range(3)]
    return np.concatenate(out, axis=1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        keys = np.sort(keys_of(fps.view(np.uint64)), axis=1)
        first = np.ones(keys.shape, bool)
        first[:, 1:] = keys[:, 1:] != keys[:, :-1]
        yield pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(np.repeat(fps, first.sum(axis=1)))], ["key", "fp"])
