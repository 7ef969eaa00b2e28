"""Phrase collocation mining by SON partitioning: local counts of shards, union, exact second count.

A shard is up to ``SHARD_BYTES`` of texts of one task (smaller partitions are put together for it), and ends earlier with ``MOST_KEYS`` different phrases.
The local support is one.  A higher one would be ``support`` times the shard's share of all text; as shards are of bounded size, that falls
as the input grows, and every shard would give out more the more of them there are.  So what a shard gives out depends on its own text.

1. Local mining, level by level: words; pairs whose words are both frequent; longer phrases whose pairs are all frequent.  Every task sorts the
   hashes of its shard's phrases, ``PART_BYTES`` of text at a time, and gives them out with their count.
2. Union.  The local counts of a phrase are added up; those that reach the support are the candidates.
3. Global count.  A second reading counts every phrase that hits the candidates' bitmap and gives it out with its text, once a task; after the
   sum over tasks the counts are exact by text, and whatever hit a bitmap by chance has an exact count too.  The support is applied to these.

Scores, containment and ranks are joins, aggregates and a limited window over the frequent phrases.

Size.  A task holds the words of one part (or one text, if that is longer) and the different phrases of one shard.  What is broadcast are two bitmaps of ``BITMAP_BITS``
bits, whatever the number of candidates: with more candidates more phrases pass that are no candidates, which costs time and changes
no result.  A very common phrase is one row per shard or part.  Rows shuffled in the first passes are at most the different phrases of every shard, so
they grow with the text.

Phrases are told apart inside a shard by 64-bit hashes of language and words (chance of a shared hash about 2**-58 a pair), in the result by text.

Defined cases.  A null text is empty and has no words; a null language is ``und``, together with a language of that name.  Repeated rows
count each.  Ties in rank are ordered by phrase.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.llm.frames import staged
from daypanel.llm.tokens import _BASE, _BYTE_VALUES, _Powers, mix

SHARD_BYTES = 64 << 20
PART_BYTES = 8 << 20
MOST_KEYS = 6_000_000
BITMAP_BITS = 1 << 24
COUNTING = 2  # tasks a core in the second reading
_CHUNK = 1 << 20
_BUCKET = 1 << 15  # bits of one row of bitmap_construct_agg

_CUT = np.zeros(256, bool)  # ends a piece: . , ; : ! ? and line breaks
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class _Part:
    """Words of the texts of one part (under 2**31 bytes, as an Arrow batch is): hash, place in ``data``, piece and language."""

    def __init__(self, texts: list[tuple[bytes, np.ndarray, np.ndarray]], langs: list[str]):
        self.data = b"".join(t[0] for t in texts)
        self.langs = langs
        self.salts = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in langs], np.uint64)
        parts, at, piece = [], 0, 0
        for data, offsets, codes in texts:
            raw = np.frombuffer(data, np.uint8)
            lo = 0
            while lo < len(codes):
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _CHUNK, side="right")) - 1)
                hashes, starts, ends, pieces, doc = _words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                first = at + int(offsets[lo])
                parts.append((hashes, (starts + first).astype(np.int32), (ends + first).astype(np.int32), (pieces + piece).astype(np.int32), codes[lo:hi][doc]))
                piece += int(pieces[-1]) + 1 if len(pieces) else 0
                lo = hi
            at += len(data)
        self.hashes, self.starts, self.ends, self.pieces, self.codes = (
            np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t)
            for k, t in enumerate((np.uint64, np.int32, np.int32, np.int32, np.int32)))

    def phrases(self, n: int, inner: int = 0, bitmap: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all phrases of ``n`` words with the places of their first words; of those alone whose phrases of ``inner`` words, if these
        are fewer, all hit the bitmap.
        """
        m = len(self.hashes) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keep = self.pieces[:m] == self.pieces[n - 1:]
        if 0 < inner < n:
            hit = self._inner_hits(inner, bitmap)
            for k in range(n - inner + 1):
                keep &= hit[k:k + m]
        at = np.flatnonzero(keep)
        return self._keys(n, at), at

    def _keys(self, n: int, at: np.ndarray) -> np.ndarray:
        total = np.full(len(at), n, np.uint64)
        for k in range(n):
            total = total * np.uint64(_BASE) + self.hashes[at + k]
        return mix(total ^ self.salts[self.codes[at]])

    def _inner_hits(self, n: int, bitmap: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_hit"):  # a part is read for one bitmap
            keys, at = self.phrases(n)
            self._hit = np.zeros(len(self.hashes), bool)
            self._hit[at] = _hits(bitmap, keys)
        return self._hit


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of consecutive texts: hashes (lower-cased), starts, ends, piece numbers, and the text each is in."""
    cut = _CUT[data]
    inside = ~(cut | _BLANK[data])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _Powers.of(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[_LOWER[data]] * up, out=running[1:])
    hashes = mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return hashes, starts, ends, np.cumsum(cut)[starts] + doc, doc


def _parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[_Part]:
    """Consecutive texts of about ``most`` bytes; a longer text is a part of its own."""
    texts, size = [], 0
    codes: dict[str, int] = {}

    def full() -> _Part:
        return _Part(texts, list(codes))

    for batch in batches:
        said = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "").cast(pa.large_binary())
        langs = pc.fill_null(batch.column(batch.schema.get_field_index("lang")), "und").to_pylist()
        offsets = np.frombuffer(said.buffers()[1], np.int64)[said.offset:said.offset + len(said) + 1]
        raw = said.buffers()[2]
        lo = 0
        while lo < len(said):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max(most - size, 0), side="right")) - 1)
            data = raw[offsets[lo]:offsets[hi]].to_pybytes() if raw is not None else b""
            at = np.array([codes.setdefault(x, len(codes)) for x in langs[lo:hi]], np.int32)
            texts.append((data, offsets[lo:hi + 1] - offsets[lo], at))
            size += len(data)
            lo = hi
            if size >= most:
                yield full()
                texts, size, codes = [], 0, {}
    if texts:
        yield full()


def _hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _miner(lengths: tuple[int, ...], shard_bytes: int, part_bytes: int, inner: int = 0, bitmap: Broadcast | None = None):
    """Rows of (key, local count) of the shards' phrases."""
    def rows(found: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for keys, n in found.values():
            for lo in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo:lo + 100_000].view(np.int64)), pa.array(n[lo:lo + 100_000])], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = {}, 0
        for part in _parts(batches, part_bytes):
            size += len(part.data)
            for words in lengths:
                found[words] = _added(found.get(words), part.phrases(words, inner, bitmap and bitmap.value)[0])
            if size >= shard_bytes or sum(len(keys) for keys, _ in found.values()) >= MOST_KEYS:
                yield from rows(found)
                found, size = {}, 0
        yield from rows(found)

    return run


def _added(counted: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and their counts, with those of ``counted``."""
    keys, n = np.unique(keys, return_counts=True)
    n = n.astype(np.int64)
    if counted is None:
        return keys, n
    keys, n = np.concatenate([counted[0], keys]), np.concatenate([counted[1], n])
    order = np.argsort(keys, kind="stable")  # two sorted runs
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _counter(lengths: tuple[int, ...], part_bytes: int, most: int, candidates: Broadcast, pairs: Broadcast):
    """Rows of (lang, phrase, words, count) of the phrases that hit the candidates, once a task or ``most`` phrases; without a phrase: the number of all words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, slots, counts, said = none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), ()

        def rows() -> Iterator[pa.RecordBatch]:
            at = 0
            for columns in said:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[at:at + len(columns[0])])], schema=schema)
                at += len(columns[0])

        for part in _parts(batches, part_bytes):
            sizes = np.bincount(part.codes, minlength=len(part.langs))
            langs = len(part.langs)
            yield pa.RecordBatch.from_arrays([pa.array(part.langs, pa.string()), pa.nulls(langs, pa.string()),
                                              pa.array([0] * langs, pa.int32()), pa.array(sizes.astype(np.int64))], schema=schema)
            for words in lengths:
                mine, at = part.phrases(words, 2, pairs.value)
                hit = _hits(candidates.value, mine)
                mine, first, n = np.unique(mine[hit], return_index=True, return_counts=True)
                place = np.searchsorted(keys, mine)
                new = np.append(keys, np.uint64(0))[place] != mine
                new |= place == len(keys)
                counts[slots[place[~new]]] += n[~new]
                said = (*said, *_said(part, words, at[hit][first[new]]))  # in the order of the slots
                slots = np.insert(slots, place[new], len(counts) + np.arange(np.count_nonzero(new)))
                keys, counts = np.insert(keys, place[new], mine[new]), np.concatenate([counts, n[new].astype(np.int64)])
            if len(keys) >= most:
                yield from rows()
                keys, slots, counts, said = none
        yield from rows()

    return run


def _said(part: _Part, words: int, first: np.ndarray) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """Language, text and number of words of the phrases that begin at the words ``first``, some at a time."""
    for lo in range(0, len(first), 50_000):
        some = first[lo:lo + 50_000]
        texts = [b" ".join(part.data[a:b].lower().split()) for a, b in
                 zip(part.starts[some].tolist(), part.ends[some + words - 1].tolist())]
        langs = [part.langs[c] for c in part.codes[some].tolist()]
        yield pa.array(langs, pa.string()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.full(len(some), words, np.int32))


def _candidates(mined: DataFrame, support: int, label: str) -> DataFrame:
    """``key`` of the phrases whose local counts reach the support together."""
    # Keys differ inside a shard: they are dealt out as they are, since adding them up in the task before would only take memory.
    sums = mined.repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    return staged(sums.where(F.col("n") >= support).select("key"), label)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of the keys' low bits, put together by the executors: the driver gets ``BITMAP_BITS`` bits, however many keys there are."""
    at = F.col("key").bitwiseAND(F.lit(BITMAP_BITS - 1))
    rows = keys.select((at / _BUCKET).cast("int").alias("bucket"), (at % _BUCKET).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in rows:
        at_byte = r["bucket"] * _BUCKET // 8
        out[at_byte:at_byte + _BUCKET // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def phrase_counts(docs: DataFrame, support: int, longest: int, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of every phrase of 1 to ``longest`` words with at least ``support`` occurrences, and ``lang, n`` of all words."""
    texts = docs.select("lang", "text")
    context = docs.sparkSession.sparkContext
    all_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    part = min(PART_BYTES, shard_bytes)
    # A shard ends with its task, and the larger a shard the more often its phrases repeat in it: tasks hold two thirds of the most a shard may,
    # so that uneven ones leave no small shard at their end.
    tasks = max(context.defaultParallelism, -(-3 * all_bytes // (2 * shard_bytes)))
    shards = texts.coalesce(tasks)

    def level(lengths: tuple[int, ...], label: str, inner: int = 0, bitmap: Broadcast | None = None) -> DataFrame:
        return _candidates(shards.mapInArrow(_miner(lengths, shard_bytes, part, inner, bitmap), "key bigint, n bigint"), support, label)

    words = level((1,), "words")
    twos = level((2,), "pairs", 1, context.broadcast(_bitmap(words)))
    pairs = context.broadcast(_bitmap(twos))
    longer = tuple(range(3, longest + 1))
    found = words.unionByName(twos)
    if longer:
        found = found.unionByName(level(longer, "long-phrases", 2, pairs))
    candidates = context.broadcast(_bitmap(found))
    # A task gives out a phrase once, so with as many tasks as the cores pay for the rows grow as the candidates do.
    counting = texts.coalesce(max(1, round(COUNTING * context.defaultParallelism)))
    counted = counting.mapInArrow(_counter((1, 2, *longer), part, MOST_KEYS // 3, candidates, pairs), "lang string, phrase string, words int, n bigint")
    sums = staged(counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")), "phrase-counts")
    return (sums.where(F.col("phrase").isNotNull() & (F.col("n") >= support)), sums.where(F.col("phrase").isNull()).select("lang", "n"))


def _joined(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int | None = 2000, covered: int = 100,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The phrases of 2 to ``longest`` words whose words stand together far more often than their parts would by chance.

    ``lang, rank, phrase, a, l, r, n, score`` with a = occurrences, l and r = those of the parts of the lowest-scoring cut, n = words of the
    language, score = floor(1000 a n / (l r)).  Phrases inside a longer one that has ``covered`` per cent of their occurrences are left out.  The first
    ``top`` of each language (all: None), by score and a descending, then phrase.
    """
    counts, sizes = phrase_counts(docs, support, longest, shard_bytes)
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    listed = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("said"))
    cut = listed.select("lang", "phrase", "words", "a", "said", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _joined(F.col("said"), F.lit(1), F.col("k")).alias("left"),
                     _joined(F.col("said"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(parts.select("lang", F.col("part").alias(side), F.col("part_n").alias(name)), ["lang", side])
    cut = cut.join(sizes, "lang")
    whole = "decimal(38,0)"  # 1000 a n passes 64 bits
    score = F.expr(f"cast(1000 as {whole}) * cast(a as {whole}) * cast(n as {whole}) div (cast(l as {whole}) * cast(r as {whole}))")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = listed.where("words > 2").select("lang", "a", "words", "said", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    inside = inside.select("lang", "a", "m", "said", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("at"))
    inside = inside.select("lang", "a", _joined(F.col("said"), F.col("at"), F.col("m")).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("inside_a"))
    kept = scored.join(most, ["lang", "phrase"], "left").where(
        F.col("inside_a").isNull() | (F.col("inside_a") * 100 < F.col("a") * covered))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rows = kept.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
