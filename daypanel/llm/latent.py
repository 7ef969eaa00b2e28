"""Benchmark decontamination by latent semantic retrieval.

The benchmark is taken in blocks of bounded size; the steps below run for each block against all documents.

1. Documents are read once: of their words those that occur in the block are kept, as (position, number in the block's vocabulary).
   Other words can neither raise a cosine nor a common subsequence with an item.
2. Passages are windows of ``WINDOW`` words.  Words are weighted with the square of their inverse passage frequency, counted over
   all passages.
3. A randomised SVD of the passage-by-word matrix is computed by distributed sums: A'A applied to a random matrix, its
   orthonormal basis, and the Gram matrix inside that basis.  What comes to the driver is vocabulary x rank numbers.
   The basis is fitted to all passages: tasks count once which words stand together in a passage, the non-zeros of their part of A'A,
   and multiply those.
4. Passages whose latent cosine with an item reaches ``MIN_COSINE`` are candidates; there is no limit on their number.
   A passage of fixed width says little about much shorter or longer items, so the second source of candidates is a bound that no
   leak can miss, whatever its length: of the item's words without its commonest ones, so many must stand around the passage as the
   least common subsequence needs even if it holds all of the commonest ones.
5. Of every candidate the longest common subsequence of words with the item, around the passage, decides, and for
   paraphrases the part of it that lies in the item's answer (its last sentence).

Everything is a sum over rows or a row-by-row step, so hot sources and copies need no shuffle of text at all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daypanel.llm import tokens
from daypanel.llm.frames import staged

WINDOW, STRIDE = 32, 16
RANK, OVERSAMPLE = 160, 16
MIN_COSINE = 0.6
#: Passages whose words a task counts before it gives the counts out.  The basis is fitted to all passages, whatever this is.
FIT_PASSAGES = 400_000
#: A leak: this share of the item's words in order; or a paraphrase: the lower share, and that share of the answer's words.
EXACT_LCS, PARAPHRASE_LCS, ANSWER_LCS = 0.8, 0.6, 0.8
LEAST_WORDS = 8
BLOCK_CHARS = 200_000
_CHUNK = 50_000
_PAIRS = 1 << 21


@dataclass(frozen=True)
class Block:
    """Some benchmark items: their words as numbers into a sorted vocabulary of word hashes."""

    ids: list[int]
    items: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray = field(repr=False)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", min_cosine: float = MIN_COSINE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Leaks: ``doc_id, item_id, cosine, lcs, answer_lcs, start_word``, one row per document and item.

    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case.  ``lcs`` and ``answer_lcs`` are shares of the item's and its
    answer's words.  Items and texts without words, null ones included, match nothing; an item of fewer than ``LEAST_WORDS`` words
    must be there in full.  Repeated documents or items give one row per id pair.  Rows without an id are left out.  Other columns are
    not read.  Runs jobs; the benchmark passes through the driver in blocks of ``block_chars`` at most (one item at least).
    """
    spark = docs.sparkSession
    texts = docs.where(docs[doc].isNotNull()).select(docs[doc].alias("doc_id"), docs[text].alias("body"))
    items = benchmark.where(benchmark[item].isNotNull() & (F.length(benchmark[item_text]) > 0)).select(
        benchmark[item].alias("item_id"), benchmark[item_text].alias("body")).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("n")).first()["n"]
    out = spark.createDataFrame([], "doc_id bigint, item_id bigint, cosine double, lcs double, answer_lcs double, start_word int")
    rows: list[tuple[int, str]] = []
    size = 0
    for row in items.orderBy("item_id", "body").toLocalIterator() if chars else ():
        if rows and size + len(row["body"]) > block_chars:
            out, rows, size = out.unionByName(_block_leaks(texts, block_of(rows), min_cosine)), [], 0
        rows.append((row["item_id"], row["body"]))
        size += len(row["body"])
    if rows:
        out = out.unionByName(_block_leaks(texts, block_of(rows), min_cosine))
    best = F.struct("lcs", "answer_lcs", "cosine", -F.col("start_word"))
    return out.groupBy("doc_id", "item_id").agg(F.max(best).alias("best")).select(
        "doc_id", "item_id", "best.cosine", "best.lcs", "best.answer_lcs", (-F.col("best.col4")).alias("start_word"))


def block_of(rows: list[tuple[int, str]]) -> Block:
    """A block of items; items without words are left out."""
    known = [(i, _hashes(body), _hashes(_answer(body))) for i, body in rows]
    known = [x for x in known if len(x[1])]
    vocabulary = np.unique(np.concatenate([h for _, h, _ in known])) if known else np.zeros(0, np.uint64)
    return Block([i for i, _, _ in known], [np.searchsorted(vocabulary, h) for _, h, _ in known],
                 [np.searchsorted(vocabulary, a) for _, _, a in known], vocabulary)


def _answer(body: str) -> str:
    """The last sentence of an item; the last quarter of its words if there is only one."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+|\n+", body) if re.search(r"\w", s)]
    words = body.split()
    return sentences[-1] if len(sentences) > 1 else " ".join(words[-max(1, len(words) // 4):])


def _hashes(body: str) -> np.ndarray:
    parts = [w.hashes for w in tokens.word_chunks(pa.array([body]), tokens.ALPHANUMERIC)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _block_leaks(texts: DataFrame, block: Block, min_cosine: float) -> DataFrame:
    spark = texts.sparkSession
    if not block.ids:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, cosine double, lcs double, answer_lcs double, start_word int")
    # A block's vocabulary is bounded by block_chars.
    shared = spark.sparkContext.broadcast(block)
    known = staged(texts.mapInArrow(_known_words(shared), "doc_id bigint, n_words int, at binary, word binary"), "benchmark-words")
    size = len(block.vocabulary)
    counted = known.mapInArrow(_passage_counts(size), "part int, block int, sums binary")
    counts = _summed(counted, size + 1, 1)[:, 0]
    weights = np.log((1.0 + counts[-1]) / (1.0 + counts[:-1])) ** 2
    basis = latent_basis(known, weights)
    rare = spark.sparkContext.broadcast(_rare_words(block, counts[:-1] / max(1.0, float(counts[-1]))))
    return known.mapInArrow(
        _search(shared, spark.sparkContext.broadcast((basis * weights[:, None]).astype(np.float32)), rare, min_cosine),
        "doc_id bigint, item_id bigint, cosine double, lcs double, answer_lcs double, start_word int")


def latent_basis(known: DataFrame, weights: np.ndarray, rank: int = RANK, oversample: int = OVERSAMPLE) -> np.ndarray:
    """Right singular vectors (vocabulary x rank) of the weighted passage-by-word matrix."""
    size = len(weights)
    width = min(rank + oversample, size)
    together = staged(known.mapInArrow(_together(size, FIT_PASSAGES), "pairs binary, times binary"), "words-together")
    start = np.random.default_rng(7).standard_normal((size, width))
    sketch = _summed(together.mapInArrow(_gram_times(_weighted(known, weights, start), size), _SUMS), size, width)
    basis, _ = np.linalg.qr(sketch * weights[:, None])
    gram = _summed(together.mapInArrow(_gram_inside(_weighted(known, weights, basis), size), _SUMS), width, width)
    values, vectors = np.linalg.eigh(gram)
    return basis @ vectors[:, np.argsort(-values)[:min(rank, width)]]


_SUMS = "part int, block int, sums binary"
_ROWS = 512


def _weighted(known: DataFrame, weights: np.ndarray, matrix: np.ndarray):
    return known.sparkSession.sparkContext.broadcast((matrix * weights[:, None]).astype(np.float32))


def _summed(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """The sum of the matrices that tasks emit in blocks of rows, over two levels of tasks; the result is rows x width."""
    wide = max(1, math.isqrt(parts.sparkSession.sparkContext.defaultParallelism))
    level = parts.repartition(4 * wide, "block", F.col("part") % wide).mapInArrow(_add, _SUMS)
    out = np.zeros((rows, width))
    for r in level.repartition(wide, "block").mapInArrow(_add, _SUMS).toLocalIterator():
        at = r["block"] * _ROWS
        part = np.frombuffer(r["sums"]).reshape(-1, width)
        out[at:at + len(part)] += part
    return out


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            part = np.frombuffer(data)
            sums[block] = sums[block] + part if block in sums else part
    yield from _emitted(sums.items())


def _emitted(blocks) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for block, data in blocks:
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([data.tobytes()], pa.binary())],
            ["part", "block", "sums"])


def _in_blocks(matrix: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    return ((k, matrix[a:a + _ROWS].astype(np.float64)) for k, a in enumerate(range(0, len(matrix), _ROWS)))


def _known_words(shared):
    """Per document its number of words, and positions and numbers of those that the block's items use."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        marks = np.zeros(1 << 20, bool)  # most words are not in the vocabulary: a first look at some bits of the hash
        marks[vocabulary >> np.uint64(44)] = True
        for batch in batches:
            ids = batch.column("doc_id")
            for words in tokens.word_chunks(batch.column("body"), tokens.ALPHANUMERIC):
                maybe = np.flatnonzero(marks[words.hashes >> np.uint64(44)])
                place = np.minimum(np.searchsorted(vocabulary, words.hashes[maybe]), len(vocabulary) - 1)
                sure = vocabulary[place] == words.hashes[maybe]
                at, word = maybe[sure], place[sure].astype(np.int32)
                cuts = np.searchsorted(at, words.bounds)
                n = len(words.bounds) - 1
                rows = [k for k in range(n) if cuts[k] < cuts[k + 1] or words.bounds[k] < words.bounds[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(words.first, n).take(pa.array(rows, pa.int64())),
                     pa.array(np.diff(words.bounds)[rows].astype(np.int32), pa.int32()),
                     pa.array([(at[cuts[k]:cuts[k + 1]] - words.bounds[k]).astype(np.int32).tobytes() for k in rows], pa.binary()),
                     pa.array([word[cuts[k]:cuts[k + 1]].tobytes() for k in rows], pa.binary())],
                    ["doc_id", "n_words", "at", "word"])

    return run


@dataclass
class _Chunk:
    """Documents side by side: stride number and vocabulary number of every kept word, in order."""

    ids: list[int]
    at: list[np.ndarray]
    word: np.ndarray
    stride: np.ndarray
    cuts: np.ndarray
    first_stride: np.ndarray

    @property
    def strides(self) -> int:
        return int(self.first_stride[-1])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    """Documents of about ``_CHUNK`` kept words at a time."""
    def chunk(rows: list[tuple]) -> _Chunk:
        at = [np.frombuffer(r[2], np.int32) for r in rows]
        first = np.concatenate([[0], np.cumsum([max(1, -(-r[1] // STRIDE)) for r in rows])]).astype(np.int64)
        return _Chunk([r[0] for r in rows], at, np.concatenate([np.frombuffer(r[3], np.int32) for r in rows]),
                      np.concatenate([a // STRIDE + f for a, f in zip(at, first[:-1], strict=True)]),
                      np.concatenate([[0], np.cumsum([len(a) for a in at])]), first)

    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_words", "at", "word")), strict=True):
            rows.append(row)
            held += len(row[2]) // 4 + row[1] // STRIDE
            if held >= _CHUNK:
                yield chunk(rows)
                rows, held = [], 0
    if rows:
        yield chunk(rows)


def _group_sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Row sums per group, for groups in ascending order."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(groups):
        starts = np.flatnonzero(np.diff(groups, prepend=-1))
        out[groups[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def _stride_sums(matrix: np.ndarray, c: _Chunk) -> np.ndarray:
    """The sum of the rows of ``matrix`` that the words of each stride name.

    Strides hold a few words: the first of all strides are added, then the second of those that have one, and so on.
    """
    counts = np.bincount(c.stride, minlength=c.strides)
    order = np.argsort(-counts, kind="stable")
    starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    sums = np.zeros((c.strides, matrix.shape[1]), matrix.dtype)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -k))
        sums[:live] += matrix[c.word[starts[:live] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _passage_counts(size: int):
    """How many passages (strides, which tile the text) hold each word, and at the end how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for c in _chunks(batches):
            once = np.unique(c.stride * size + c.word) % size
            counts[:-1] += np.bincount(once, minlength=size)
            counts[-1] += c.strides
        yield from _emitted(_in_blocks(counts[:, None]))

    return run


def _together(size: int, passages: int):
    """The non-zeros of a task's part of A'A: ``a * size + b`` for words ``a <= b`` of one stride, and how often they stand there together.

    A pair of unlike words counts for both triangles.
    """
    def counted(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate(pairs), return_inverse=True)
        return keys, np.bincount(place, weights=np.concatenate(times), minlength=len(keys)).astype(np.int64)

    def row(pairs: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = counted(pairs, times)
        return pa.RecordBatch.from_arrays([pa.array([keys.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["pairs", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[np.ndarray] = []
        times: list[np.ndarray] = []
        taken = 0
        for c in _chunks(batches):
            word = c.word.astype(np.int64)
            found = [word * (size + 1)]
            for after in range(1, STRIDE):
                k = np.flatnonzero(c.stride[after:] == c.stride[:-after])
                a, b = word[k], word[k + after]
                both = np.minimum(a, b) * size + np.maximum(a, b)
                found += [both, both[a == b]]
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            pairs.append(keys)
            times.append(n)
            taken += c.strides
            if sum(map(len, pairs)) > _PAIRS:
                keys, n = counted(pairs, times)
                pairs, times = [keys], [n]
            if taken >= passages or len(pairs) == 1 and len(pairs[0]) > _PAIRS // 2:
                yield row(pairs, times)
                pairs, times, taken = [], [], 0
        if pairs:
            yield row(pairs, times)

    return run


def _applied(batches: Iterator[pa.RecordBatch], m: np.ndarray, size: int) -> np.ndarray:
    """A'(A M) of the batches' words that stand together."""
    total = np.zeros((size, m.shape[1]))
    for batch in batches:
        for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True):
            a, b = np.divmod(np.frombuffer(pairs, np.int64), size)
            n = np.frombuffer(times, np.int64).astype(np.float32)
            unlike = a != b
            for rows, others, n_of in ((a, b, n), (b[unlike], a[unlike], n[unlike])):
                order = np.argsort(rows, kind="stable")
                for lo in range(0, len(order), _ROWS * 16):
                    k = order[lo:lo + _ROWS * 16]
                    starts = np.flatnonzero(np.diff(rows[k], prepend=-1))
                    total[rows[k[starts]]] += np.add.reduceat(m[others[k]] * n_of[k, None], starts, axis=0)
    return total


def _gram_times(matrix, size: int):
    """A'(A M) without the weights of the outer A', which the caller multiplies in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emitted(_in_blocks(_applied(batches, matrix.value, size)))

    return run


def _gram_inside(matrix, size: int):
    """(A M)'(A M)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matrix.value
        yield from _emitted(_in_blocks(m.T.astype(np.float64) @ _applied(batches, m, size)))

    return run


def places_of(item: np.ndarray) -> dict[int, int]:
    """For each word of an item the bits of its places."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def common_subsequence(item: np.ndarray, words: list[int], masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, one machine-wide step per word (bit-parallel)."""
    masks = places_of(item) if masks is None else masks
    full = (1 << len(item)) - 1
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def leak(item: np.ndarray, answer: np.ndarray, words: list[int], masks: dict[int, int] | None = None) -> tuple[float, float] | None:
    """Shares of the item and of its answer that ``words`` hold in order, if that makes a leak."""
    share = common_subsequence(item, words, masks) / len(item)
    need = 1.0 if len(item) < LEAST_WORDS else EXACT_LCS
    if share < min(need, PARAPHRASE_LCS):
        return None
    answered = common_subsequence(answer, words) / len(answer) if len(answer) else 0.0
    if share >= need or len(item) >= LEAST_WORDS and share >= PARAPHRASE_LCS and answered >= ANSWER_LCS:
        return share, answered
    return None


def _least(block: Block) -> np.ndarray:
    """How many words a common subsequence with each item needs to make a leak."""
    return np.array([math.ceil((1.0 if len(i) < LEAST_WORDS else PARAPHRASE_LCS) * len(i)) for i in block.items])


def _rare_words(block: Block, shares: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each item its words without the commonest, and how many of them stand around every leak of the item.

    shares: the share of strides that hold a word.  As many of the commonest are left out as make it least likely (Chernoff's bound
    for independent words) that a place which is no leak has enough of the others.
    """
    words_of, needs = [], []
    for item, least in zip(block.items, _least(block).tolist(), strict=True):
        words, times = np.unique(item, return_counts=True)
        order = np.argsort(-shares[words], kind="stable")
        words, times = words[order], times[order]
        strides = WINDOW // STRIDE + 2 * -(-len(item) // STRIDE)
        need = least - np.concatenate([[0], np.cumsum(times)[:-1]])
        need = need[need > 0]
        expected = strides * np.cumsum(shares[words][::-1])[::-1][:len(need)] + 1e-9
        surprise = np.where(need > expected, need * np.log(need / expected) - need + expected, 0.0)
        first = int(np.argmax(surprise))
        words_of.append(words[first:])
        needs.append(int(need[first]))
    return words_of, np.array(needs)


def _by_count(c: _Chunk, block: Block, rare: tuple[list[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Passages and items with enough of the item's rarer words around the passage; every leak is among them."""
    words_of, need = rare
    back = np.array([-(-len(i) // STRIDE) for i in block.items])
    order = np.argsort(back, kind="stable")
    at = np.arange(c.strides)
    doc = np.repeat(np.arange(len(c.ids)), np.diff(c.first_stride))
    near, item = [], []
    for k in range(0, len(order), 256):
        some = order[k:k + 256]
        member = np.zeros((len(block.vocabulary), len(some)), np.int16)
        for x, j in enumerate(some.tolist()):
            member[words_of[j], x] = 1
        held = np.zeros((c.strides + 1, len(some)), np.int32)
        np.cumsum(_stride_sums(member, c), axis=0, out=held[1:])
        for reach in np.unique(back[some]).tolist():
            mine = slice(*np.searchsorted(back[some], [reach, reach + 1]).tolist())
            hi, lo = np.minimum(at + WINDOW // STRIDE + reach, c.first_stride[doc + 1]), np.maximum(at - reach, c.first_stride[doc])
            p, x = np.nonzero(held[hi, mine] - held[lo, mine] >= need[some[mine]])
            near.append(p)
            item.append(some[mine][x])
    return np.concatenate(near), np.concatenate(item)


def _search(shared, matrix, rare, min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, m = shared.value, matrix.value
        items = np.array([m[i].sum(axis=0) for i in block.items], np.float32)
        items /= np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-12)
        member = np.zeros((len(block.vocabulary), len(items)), np.int32)  # how often an item has a word
        for j, i in enumerate(block.items):
            np.add.at(member[:, j], i, 1)
        masks = [places_of(i) for i in block.items]
        for c in _chunks(batches):
            rows = _chunk_leaks(c, block, m, items, masks, member, rare.value, min_cosine)
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                             ["doc_id", "item_id", "cosine", "lcs", "answer_lcs", "start_word"])

    return run


def _chunk_leaks(c: _Chunk, block: Block, m: np.ndarray, items: np.ndarray, masks: list[dict[int, int]], member: np.ndarray,
                 rare: tuple[list[np.ndarray], np.ndarray], min_cosine: float) -> list[tuple]:
    strides = _stride_sums(m, c)
    follows = np.ones(c.strides, bool)
    follows[c.first_stride[1:] - 1] = False  # the last stride of a document has no next
    passages = strides.copy()
    passages[:-1] += np.where(follows[:-1, None], strides[1:], 0)
    norms = np.linalg.norm(passages, axis=1)
    near, item = _by_count(c, block, rare)
    pairs = [near * len(items) + item]
    for lo in range(0, c.strides, 8192):
        part = passages[lo:lo + 8192]
        near, item = np.nonzero((part @ items.T >= min_cosine * norms[lo:lo + 8192, None]) & (norms[lo:lo + 8192, None] > 0))
        pairs.append((near + lo) * len(items) + item)
    near, item = np.divmod(np.unique(np.concatenate(pairs)), len(items))
    doc = np.searchsorted(c.first_stride, near, side="right") - 1
    out = []
    for p, j, d in _enough_words(c, block, near, item, doc, member):
        a, b, begin = _around(c, block, p, j, d)
        words = c.word[a:b]
        found = leak(block.items[j], block.answers[j], words[member[words, j] > 0].tolist(), masks[j])  # others cannot match
        if found:
            cosine = float(passages[p] @ items[j] / max(float(norms[p]), 1e-12))
            out.append((c.ids[d], block.ids[j], cosine, *found, begin))
    return out


def _enough_words(c: _Chunk, block: Block, near: np.ndarray, item: np.ndarray, doc: np.ndarray,
                  member: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Candidates whose surroundings hold enough of the item's words, in any order: never fewer than in order.

    A word counts as often as the item has it, at most.
    """
    least = _least(block)[item]
    lengths = np.array([len(i) for i in block.items])
    back = -(-lengths[item] // STRIDE)
    lo = np.searchsorted(c.stride, np.maximum(near - back, c.first_stride[doc]))
    hi = np.searchsorted(c.stride, np.minimum(near + WINDOW // STRIDE + back, c.first_stride[doc + 1]))
    for k in range(0, len(near), 1 << 14):
        a, b = lo[k:k + (1 << 14)], hi[k:k + (1 << 14)]
        size = b - a
        owner = np.repeat(np.arange(len(a)), size)
        word = c.word[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)]
        times = member[word, item[k:k + (1 << 14)][owner]]
        enough = np.bincount(owner[times > 0], minlength=len(a)) >= least[k:k + (1 << 14)]
        left = np.flatnonzero((times > 0) & enough[owner])
        _, first, n = np.unique(owner[left] * len(member) + word[left], return_index=True, return_counts=True)
        held = np.bincount(owner[left[first]], weights=np.minimum(n, times[left[first]]), minlength=len(a))
        for x in np.flatnonzero(held >= least[k:k + (1 << 14)]).tolist():
            yield int(near[k + x]), int(item[k + x]), int(doc[k + x])


def _around(c: _Chunk, block: Block, passage: int, item: int, doc: int) -> tuple[int, int, int]:
    """The kept words around a passage: it and the item's length to both sides, inside the document."""
    length = len(block.items[item])
    begin = (passage - int(c.first_stride[doc])) * STRIDE
    at = c.at[doc]
    a = int(np.searchsorted(at, begin - length))
    b = int(np.searchsorted(at, begin + WINDOW + length))
    base = int(c.cuts[doc])
    return base + a, base + b, max(0, begin)
