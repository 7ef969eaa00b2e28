r"""Secret scans with an incremental blob ledger.

Every version of every file is content-addressed; the ledger says which (blob, rule, rule version) was scanned and what
was found.  A scan looks only at pairs the ledger lacks, each blob's text once, and findings are joined back to all paths
that hold the blob.

Copies are folded inside each task before anything is shuffled (an aggregate by blob), so a blob that a third of
all paths hold costs one text per task.  The join back is by blob, with the paths as the large side; adaptive execution splits
a hot blob there.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daypanel.llm.frames import per_row


@dataclass(frozen=True)
class Rule:
    """A pattern with a version: raise the version whenever the pattern changes.

    hints: the pattern matches no text that holds none of these (compared without letter case).
    group, least: a match counts if this group has at least so many characters.
    """

    name: str
    version: int
    pattern: str
    hints: tuple[str, ...] = ()
    group: int = 0
    least: int = 0
    flags: int = re.ASCII

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: Fixed by the contract of the secret scan, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ("password", "passwd", "secret", "token", "api_key", "apikey"), 2, 6, re.ASCII | re.IGNORECASE),
    # A run of fewer characters never holds a longer one, so the length can stand in the pattern.
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", ("akia",)),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
#: Public token formats beyond the base kinds.
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", ("private key-----",)),
    # Only at the start of a run of its characters: else a long run would be read once for every hyphen in it.
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyj",)),
    Rule("code_host", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", 1, r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}", ("xoxa-", "xoxb-", "xoxe-", "xoxo-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("url_login", 1, r"\b[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@", ("://",), 0, 0, re.ASCII | re.IGNORECASE),
)
RULES = (*BASE_RULES, *MORE_RULES)

LEDGER = "blob binary, rule string, spans array<struct<start:bigint,end:bigint>>"


def blobs(paths: DataFrame, text: str = "text") -> DataFrame:
    """The paths' columns packed as ``row``, with the address ``blob`` of their content (null content is empty)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return paths.select(F.struct("*").alias("row"), F.unhex(F.sha2(body, 256)).alias("blob"), body.alias("body"))


def scan(paths: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """New ledger rows: for every blob of ``paths`` and every rule version that ``ledger`` lacks, the spans found.

    ``blob, rule ("name@version"), spans``; a pair without findings has an empty list, so that it counts as scanned.
    Spans are code points, end exclusive.  Appending the result to the ledger makes the next scan skip those pairs.
    A ledger with repeated rows is fine; an empty or missing one means that nothing was scanned yet.
    """
    once = blobs(paths, text).select("blob", "body").groupBy("blob").agg(F.first("body").alias("body"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        pending = once.withColumn("pending", wanted)
    else:
        known = ledger.where(F.col("rule").isin([r.key for r in rules]))
        seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))  # at most one entry per rule
        pending = (
            once.join(seen, "blob", "left")
            .withColumn("pending", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("pending") > 0).drop("seen")
        )
    found = pending.mapInArrow(_scanner(tuple(rules)), "blob binary, found array<struct<rule:string,"
                                                       "spans:array<struct<start:bigint,end:bigint>>>>")
    return found.select("blob", F.inline("found"))


def findings(paths: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``paths`` with ``findings``: the ledger's findings of each row's content under the given rule versions.

    ``findings`` lists ``start, ord, kind, end`` by start, then the order of ``rules``; empty if there are none.  A column
    of that name is replaced.  Rows whose blob the ledger lacks get an empty list.
    """
    order = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))])
    hits = (
        ledger.where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
        .select("blob", "rule", F.inline("spans")).distinct()
        .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct(
            "start", order[F.col("rule")].alias("ord"), F.substring_index("rule", "@", 1).alias("kind"), "end"))).alias("hits"))
    )
    joined = blobs(paths, text).select("row", "blob").join(hits, "blob", "left")
    none = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>")
    keep = [F.col(f"row.`{c}`").alias(c) for c in paths.columns if c != "findings"]
    return joined.select(*keep, F.coalesce("hits", none).alias("findings"))


def spans_of(text: str, rules: Iterable[Rule]) -> list[tuple[str, list[tuple[int, int]]]]:
    """What each rule finds in a text: leftmost, not overlapping within a rule."""
    lowered = text.lower()
    out = []
    for rule in rules:
        hits = []
        if not rule.hints or any(h in lowered for h in rule.hints):
            for m in re.compile(rule.pattern, rule.flags).finditer(text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    hits.append(m.span())
        out.append((rule.key, hits))
    return out


def _scanner(rules: tuple[Rule, ...]):
    by_key = {r.key: r for r in rules}
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("blob", pa.binary()), ("found", pa.list_(pa.struct([("rule", pa.string()), ("spans", spans)])))])

    def one(blob: bytes, body: str, pending: list[str]) -> tuple:
        found = spans_of(body, [by_key[k] for k in pending])
        return blob, [{"rule": k, "spans": [{"start": a, "end": b} for a, b in hits]} for k, hits in found]

    return per_row(one, ["blob", "body", "pending"], schema)
