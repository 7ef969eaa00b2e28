"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule.  A policy is a
versioned set of rules, i.e. a mask: applying one, comparing two, or asking what a rule costs (ablation) reads the ledger
and no text.  Ablations aggregate counts by bit pattern first, so what is shuffled is one row per pattern and task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 8
#: Fixed by the contract: what counts as a symbol.
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
            "n_same_word", "n_bangs")


@dataclass(frozen=True)
class Rule:
    """Bit ``bit`` of the ledger is set where ``fails`` holds; a bit is never given to another rule."""

    name: str
    bit: int
    fails: Callable[[], Column]


def _over(share: float, part: str, whole: str) -> Callable[[], Column]:
    return lambda: F.col(part) * 1.0 > share * F.col(whole)


RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 20),
    Rule("repeated_words", 1, lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule("symbols", 2, _over(0.25, "n_symbols", "n_words")),
    Rule("duplicate_lines", 3, _over(0.5, "n_dup_lines", "n_lines")),
    Rule("upper_case", 4, _over(0.6, "n_upper", "n_letters")),
    Rule("same_word_again", 5, _over(0.2, "n_same_word", "n_words")),
    Rule("exclamations", 6, _over(0.5, "n_bangs", "n_words")),
    Rule("long_words", 7, _over(25.0, "word_chars", "n_words")),
)


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document is kept if it fails none of the named rules."""

    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy(1, ("few_words", "repeated_words"))
PRODUCTION = Policy(2, tuple(r.name for r in RULES))
POLICIES = (BASE, PRODUCTION)


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, all measurements, and ``fail_bits``, one row per row of ``docs``, without a shuffle.

    A null or empty text has no words, fails the minimum of words, and has 0 in every measurement.  Repeated rows give repeated
    rows.  Columns that are not carried are not read; a carried column must not be named like a measurement.
    """
    clash = {*carry} & {*MEASURES, "fail_bits"}
    if clash:
        raise ValueError(f"carried columns named like results: {sorted(clash)}")
    kept = docs.select(*carry, F.col(text).alias("__body"))
    fields = [f for f in kept.schema.fields if f.name != "__body"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], *[f"{m} bigint" for m in MEASURES]])
    measured = kept.mapInArrow(_measure(len(fields)), schema)
    bits = F.lit(0).cast("bigint")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("bigint"))
    return measured.withColumn("fail_bits", bits)


def fails(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row of the ledger is rejected by the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules))) != 0


def verdicts(rows: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``rows`` of the ledger with ``kept_v<version>`` for each policy."""
    return rows.withColumns({f"kept_v{p.version}": ~fails(p, rules) for p in policies})


def ablations(rows: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy version and rule: ``documents``, ``rejected`` by the policy, ``hit`` by the rule, ``alone``.

    ``alone`` counts documents that only this rule rejects: what the policy would keep more without it.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cells = [F.struct(F.lit(p.version).alias("version"), F.lit(p.mask(rules)).cast("bigint").alias("mask"),
                      F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("bit"))
             for p in policies for r in rules if r.name in p.rules]
    each = patterns.select("fail_bits", "n", F.inline(F.array(*cells)))
    mine = F.col("fail_bits").bitwiseAND(F.col("mask"))

    def total(hit: Column) -> Column:
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    return each.groupBy("version", "rule").agg(
        F.sum("n").alias("documents"), total(mine != 0).alias("rejected"),
        total(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("hit"), total(mine == F.col("bit")).alias("alone"))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    spaces = len(data) - len(data.translate(None, b" \t\n\x0b\x0c\r"))
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    upper = len(data.translate(None, _NOT_UPPER))
    return (len(words), len(text) - spaces, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            _repeated(codes), len(lines), upper, upper + len(data.translate(None, _NOT_LOWER)),
            int((codes[1:] == codes[:-1]).sum()), data.count(b"!"))


# The first byte of a non-ASCII character counts as a lower-case letter: few scripts have capitals.
_NOT_UPPER = bytes(c for c in range(256) if not 0x41 <= c <= 0x5A)
_NOT_LOWER = bytes(c for c in range(256) if not (0x61 <= c <= 0x7A or c >= 0xC0))


def _repeated(codes: np.ndarray) -> int:
    """How many words lie in a window of eight words that occurs at least twice.

    Exact: windows of 2, 4 and 8 words are numbered in turn, each as a pair of two numbered halves.
    """
    if len(codes) <= WINDOW or len(np.unique(codes)) == len(codes):
        return 0
    half = 1
    while half < WINDOW:
        pair = codes[:-half] * (int(codes.max()) + 1) + codes[half:]
        _, codes, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
        half *= 2
    twice = np.flatnonzero(counts[codes] > 1)
    edges = np.zeros(len(codes) + WINDOW + 1, np.int64)
    edges[twice] += 1
    edges[twice + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def _measure(carried: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in batch.column(carried).to_pylist()]
            values = np.array(rows, np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:carried], *[pa.array(values[:, k]) for k in range(len(MEASURES))]],
                                             [*batch.schema.names[:carried], *MEASURES])

    return run


def failed_names(rules: Sequence[Rule] = RULES) -> Column:
    """The names of the failed rules of a ledger row, in bit order."""
    each = [F.when(F.col("fail_bits").bitwiseAND(F.lit(1 << r.bit)) != 0, F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*each))
