"""License scans: exact phrases, and fuzzy search of short notices.

A notice may differ in up to ``errors`` edits.  Cut into ``errors + 1`` pieces, at least one piece stands there exactly, so exact
seeds lead to every place worth looking at; there the ``regex`` library's bounded-error matching verifies the edits
and gives the span.  The scan is per row, without a shuffle, whatever copies or hot sources there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Fixed by the contract: phrases of consecutive words, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Notice:
    """A short notice in lower-case words; ``errors`` single-character edits are tolerated."""

    label: str
    words: str
    errors: int

    def pieces(self) -> list[tuple[int, str]]:
        """``errors + 1`` pieces of about equal length, with their offsets."""
        cuts = [len(self.words) * k // (self.errors + 1) for k in range(self.errors + 2)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


NOTICES = (
    Notice("mit-notice", "released under the mit license", 3),
    Notice("apache-2.0-notice", "licensed under the apache license version 2 0", 4),
    Notice("gpl-3-notice", "this work is licensed under the gnu general public license version 3", 6),
    Notice("cc-by-nc-notice", "licensed under cc by nc 4 0", 2),
    Notice("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted", 8),
    Notice("all-rights-notice", "all rights reserved", 1),
    Notice("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", 8),
    Notice("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 10),
    Notice("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license", 6),
    Notice("lgpl-notice", "gnu lesser general public license", 3),
    Notice("agpl-notice", "gnu affero general public license", 3),
    Notice("gpl-2-later-notice", "either version 2 of the license or at your option any later version", 6),
    Notice("cc-by-notice", "licensed under a creative commons attribution 4 0 international license", 6),
    Notice("cc-by-sa-notice", "creative commons attribution sharealike", 3),
    Notice("cc0-notice", "to the extent possible under law the author has waived all copyright", 6),
    Notice("unlicense-notice", "this is free and unencumbered software released into the public domain", 6),
    Notice("boost-notice", "distributed under the boost software license", 4),
    Notice("eclipse-notice", "under the terms of the eclipse public license", 4),
    Notice("zlib-notice", "altered source versions must be plainly marked as such", 5),
    Notice("as-is-notice", "provided as is without warranty of any kind", 4),
    Notice("spdx-tag", "spdx license identifier", 2),
)

_WORD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


@dataclass(frozen=True)
class Hit:
    """``notice`` stands at the words ``first_word:end_word`` with ``edits`` edits."""

    label: str
    first_word: int
    end_word: int
    edits: int
    score: float


def normalised(text: str | None) -> str:
    """The text's words in lower-case ASCII letters, one space between them."""
    return b" ".join((text or "").encode().translate(_WORD).split()).decode(errors="replace")


def phrase_places(line: str) -> list[tuple[int, str]]:
    """``first word, label`` of every place of a base phrase in a normalised text."""
    padded, out = f" {line} ", []
    for phrase, label in PHRASES.items():
        needle, at, word, counted = f" {phrase} ", -1, 0, 0
        while (at := padded.find(needle, at + 1)) >= 0:
            word, counted = word + padded.count(" ", counted, at), at
            out.append((word, label))
    return out


def notice_hits(line: str, notices: Sequence[Notice] = NOTICES) -> list[Hit]:
    """Every notice in a normalised text, within its edits; places of one notice do not overlap."""
    out = []
    for notice, pieces, pattern in _compiled(tuple(notices)):
        regions: list[list[int]] = []
        starts = []
        for offset, piece in pieces:
            at = -1
            while (at := line.find(piece, at + 1)) >= 0:
                starts.append(at - offset)
        reach = len(notice.words) + notice.errors
        for start in sorted(starts):  # seeds close to each other share a region
            lo, hi = max(0, start - notice.errors), min(len(line), start + reach)
            if regions and lo <= regions[-1][1]:
                regions[-1][1] = max(regions[-1][1], hi)
            else:
                regions.append([lo, hi])
        word = counted = 0
        for lo, hi in regions:
            for m in _hits(pattern, line, lo, hi, len(notice.words) - notice.errors, reach):
                a, b = m.span()
                while a < b and line[a] == " ":
                    a += 1
                while b > a and line[b - 1] == " ":
                    b -= 1
                word, counted = word + line.count(" ", counted, a), a
                edits = sum(m.fuzzy_counts)
                out.append(Hit(notice.label, word, word + line.count(" ", a, b) + 1, edits, 1.0 - edits / len(notice.words)))
    return sorted(out, key=lambda h: (h.first_word, h.label))


def _hits(pattern: regex.Pattern, line: str, lo: int, hi: int, least: int, reach: int) -> Iterator[regex.Match]:
    """The matches in a part of a text, in order.  A long part is searched in windows of a few times a match's reach, so the time is linear in it."""
    while lo < hi:
        end = min(hi, lo + 4 * reach)
        last = lo + 2 * reach
        for m in sorted(_matches(pattern, line, lo, end, least), key=regex.Match.start):
            # What ends near the border might be better with what follows, and starts where the next window does or later.
            if end == hi or m.end() <= lo + 3 * reach:
                yield m
                last = max(last, m.end())
        lo = hi if end == hi else last


def _matches(pattern: regex.Pattern, line: str, lo: int, hi: int, least: int) -> Iterator[regex.Match]:
    """The best match in a part of a text, then those in the parts before and after it, which hold ``least`` characters or more."""
    parts = [(lo, hi)]
    while parts:
        lo, hi = parts.pop()
        m = pattern.search(line, lo, hi) if hi - lo >= least else None
        if m:
            yield m
            parts += [(lo, m.start()), (m.end(), hi)]


@lru_cache
def _compiled(notices: tuple[Notice, ...]) -> list[tuple]:
    return [(n, n.pieces(), regex.compile(f"(?b)(?:{regex.escape(n.words, special_only=True)}){{e<={n.errors}}}")) for n in notices]


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text", notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """One row per document: word count, base phrase places, notices found, labels and score.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, hits``.  ``hits`` holds each notice's label, word
    span (end exclusive), edits and score.  ``score`` is 1 where a base phrase stands, else the best notice's score, else 0.
    A null text is empty: no words, no places, empty label lists, score 0.  Repeated rows give repeated rows; other columns
    are not read.
    """
    return docs.select(docs[doc].alias("doc_id"), docs[text].alias("body")).mapInArrow(
        _scanner(tuple(notices)), "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, hits array<struct<label:string,first_word:bigint,end_word:bigint,"
        "edits:int,score:double>>")


def scan_text(text: str | None, notices: Sequence[Notice] = NOTICES) -> tuple:
    line = normalised(text)
    n_words = line.count(" ") + 1 if line else 0
    places = phrase_places(line)
    hits = notice_hits(line, notices)
    base = {label for _, label in places}
    at = [first for first, _ in places]
    score = 1.0 if places else max((h.score for h in hits), default=0.0)
    return (n_words, len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {h.label for h in hits})), score,
            [{"label": h.label, "first_word": h.first_word, "end_word": h.end_word, "edits": h.edits, "score": h.score} for h in hits])


def _scanner(notices: tuple[Notice, ...]):
    hit = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32()),
                     ("score", pa.float64())])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(hit)]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t, notices) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]], ["doc_id", *names])

    return run
