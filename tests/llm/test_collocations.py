"""Collocations against counts over plain Python word lists."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from daypanel.llm import collocations, queries

CUT, WORD = re.compile("[.,;:!?\x0A-\x0D]"), re.compile("[^\x20\x09]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, support, longest=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in CUT.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        scored = []
        for p, a in candidates.items():
            if inside[p] >= a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def table(spark, rows, parts):
    return spark.createDataFrame(rows, "lang string, text string").withColumns({
        "phrase": F.lit("x"), "n": F.lit(1), "key": F.lit(2), "words": F.lit("w")}).repartition(parts)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    found = got(queries.op13_collocations(spark, sf))
    assert found == brute(rows, 100) and found


@pytest.mark.parametrize(("support", "shard", "parts", "top"), [(3, 300, 5, 2000), (12, 2000, 3, 2000), (7, 1 << 20, 4, 5), (1, 100, 3, None)])
def test_shards_of_all_sizes(spark, support, shard, parts, top):
    rnd = random.Random(support)
    words = ["a", "B", "b", "new", "York", "city", "É", "é", "tab", "x-1", "\x00", "日本", "\x1c", "of"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \t ", "\x0b"]
    rows = []
    for _ in range(150):
        said = "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.choice([0, 1, 5, 40])))
        if rnd.random() < 0.5:
            said += " new york city hall" * rnd.randrange(3)
        rows.append((rnd.choice(["en", "de", None, "und", ""]), said))
    rows += [("en", None), (None, None), ("en", ""), ("de", "a a a a a a " * 40), ("en", "same row"), ("en", "same row")]
    found = got(collocations.collocations(table(spark, rows, parts), support=support, top=top, shard_bytes=shard))
    assert found == brute(rows, support, top=top)


def test_small_partitions_make_no_small_shards(spark, monkeypatch):
    """What the shards give out goes by their size, not by the number of partitions that the texts lie in."""
    rnd = random.Random(3)
    rows = [("en", " ".join(f"w{rnd.randrange(60)}" for _ in range(80))) for _ in range(320)]
    given, candidates = [], collocations._candidates

    def counted(mined, support, label):
        given.append(mined.count())
        return candidates(mined, support, label)

    monkeypatch.setattr(collocations, "_candidates", counted)
    found = []
    for parts in (4, 160):
        found.append(got(collocations.collocations(table(spark, rows, parts), support=60)))
    assert found[0] == found[1] == brute(rows, 60)
    assert given[2] + given[3] <= 3 * (given[0] + given[1])


def test_rows_of_the_shards_grow_with_the_text(spark, monkeypatch):
    """Rows of a shard depend on its own text, not on the share of all text that it is."""
    given, candidates = [], collocations._candidates

    def counted(mined, support, label):
        given.append(mined.count())
        return candidates(mined, support, label)

    monkeypatch.setattr(collocations, "_candidates", counted)
    made = []
    for times in (1, 8):
        rnd = random.Random(4)
        rows = [("en", " ".join(f"w{rnd.randrange(40)}" for _ in range(80)) + ", new york") for _ in range(60 * times)]
        given.clear()
        found = got(collocations.collocations(table(spark, rows, 4 * times), support=40, shard_bytes=8000))
        assert found == brute(rows, 40) and found
        made.append(sum(given))
    assert made[1] <= 8 * 1.5 * made[0]


def test_tasks_count_a_phrase_once(spark, monkeypatch):
    """The second reading gives out a row per task and phrase, not one per part of a task; with too many phrases it begins anew."""
    rnd = random.Random(6)
    rows = [("en", " ".join(f"w{rnd.randrange(20)}" for _ in range(80)) + ", new york") for _ in range(200)]
    made, counter = spark.sparkContext.accumulator(0), collocations._counter

    def counted(*args):
        def run(batches):
            for batch in counter(*args)(batches):
                made.add(batch.num_rows)
                yield batch
        return run

    monkeypatch.setattr(collocations, "_counter", counted)
    monkeypatch.setattr(collocations, "PART_BYTES", 1000)
    monkeypatch.setattr(collocations, "COUNTING", 1 / spark.sparkContext.defaultParallelism)
    for most in (6_000_000, 300):
        monkeypatch.setattr(collocations, "MOST_KEYS", most)
        before = made.value
        assert got(collocations.collocations(table(spark, rows, 3), support=20)) == brute(rows, 20)
        if most > 300:
            assert 0 < made.value - before < 1000


def test_shards_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PART_BYTES", 150)
    rnd = random.Random(5)
    rows = [(rnd.choice(["en", "de"]), " ".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(60)))) for _ in range(200)]
    assert got(collocations.collocations(table(spark, rows, 3), support=9, shard_bytes=2000)) == brute(rows, 9)


def test_bitmaps_that_let_almost_all_through(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITMAP_BITS", 1 << 15)
    rnd = random.Random(9)
    rows = [("en", " ".join(f"w{rnd.randrange(40)}" for _ in range(60))) for _ in range(60)]
    assert got(collocations.collocations(table(spark, rows, 4), support=3, shard_bytes=400)) == brute(rows, 3)


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    rows = [("en", "a", 1, big + 1), ("en", "b", 1, big + 3), ("en", "c", 1, big), ("en", "a b", 2, big - 7), ("en", "b c", 2, 5000), ("en", "a b c", 3, 4999)]
    sums = spark.createDataFrame(rows, "lang string, phrase string, words int, n bigint")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: (sums, spark.createDataFrame([("en", 900 * big)], "lang string, n bigint")))
    found = {r["phrase"]: (r["score"], r["l"], r["r"]) for r in collocations.collocations(None).collect()}
    n = 900 * big
    assert found["a b"] == (1000 * (big - 7) * n // ((big + 1) * (big + 3)), big + 1, big + 3)
    assert found["a b c"] == min((1000 * 4999 * n // ((big + 1) * 5000), big + 1, 5000), (1000 * 4999 * n // ((big - 7) * big), big - 7, big))


def test_empty_table(spark):
    assert got(collocations.collocations(table(spark, [], 2))) == []


def test_sql_counterpart(spark):
    from tests.compare import connect, differences

    sf = "/root/testdata/sf0.01"
    assert differences(queries.op13_collocations(spark, sf), connect(sf), queries.ORACLES["op13_collocations"]) == []
