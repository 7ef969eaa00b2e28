"""Cases in which an operator once did less than the whole job."""

import itertools
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daypanel.llm import blob_ledger, chat, frames, latent, notices, queries, windows
from tests.llm.test_operators import SF, WORDS, prose


# the pipeline

def test_pipeline_rows_without_an_id_and_with_repeated_ids(spark, docs):
    import corpus_pipeline

    rnd = random.Random(21)
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    alone = [" ".join(prose(rnd, 120)) for _ in range(6)]
    twice = [" ".join(prose(rnd, 120)) for _ in range(3)]
    shared = " ".join(prose(rnd, 120))
    leaking = " ".join(prose(rnd, 40)) + " " + bench[0]
    rows = [(None, t) for t in alone] + [(7, t) for t in twice] + [(8, shared), (9, shared), (None, shared), (None, alone[0]), (None, leaking), (7, alone[1])]
    kept = corpus_pipeline.near_dedup(spark, frames.staged(docs(rows), "stage"), SF)
    assert kept.columns == docs(rows).columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == Counter([(None, t) for t in [alone[0], *alone[2:], leaking]] + [(7, t) for t in [*twice, alone[1]]] + [(8, shared)])
    clean = corpus_pipeline.decontamination(spark, frames.staged(kept, "stage"), SF)
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == got - Counter([(None, leaking)])


def test_pipeline_columns_with_names_of_its_own(spark, docs):
    import corpus_pipeline

    rnd = random.Random(23)
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [" ".join(prose(rnd, 120)) for _ in range(8)]
    rows = [(k, t + "\nshared line") for k, t in enumerate(texts)] + [(50 + k, texts[k] + "\nshared line") for k in range(3)] + [(90, texts[0] + " " + bench[0])]
    rows += [(100 + k, f"{' '.join(prose(rnd, 30))}\nshared line") for k in range(20)]
    names = ["lines", "dropped", "__row", "__leaking", "row_", "bits", "lost", "hash", "place", "fp", "label", "node", "_lines"]
    start = docs(rows).drop("row").withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    at, left = start, []
    for name, stage in corpus_pipeline.STAGES[1:4]:
        at = stage(spark, frames.staged(at, "stage"), SF)
        assert at.columns == start.columns, name
        left.append({r["doc_id"] for r in at.collect()})
        assert all(r[n] == f"{n}{r['doc_id']}" for r in at.collect() for n in names)
    assert left[0] == {i for i, _ in rows} and left[1] == left[0] - {50, 51, 52} and left[2] == left[1] - {90}
    assert not any("shared line" in r["text"] for r in at.collect())


def test_rows_without_those_of_a_list(spark):
    rows = spark.createDataFrame([(k % 7 if k % 5 else None, f"t{k}") for k in range(200)], "key int, bits string")
    lost = frames.staged(spark.createDataFrame([(1,), (3,), (3,), (None,)], "bits int"), "lost")
    for n_bits in (64, 1 << 12):  # the smaller one lets most rows through to the join
        found = Counter(tuple(r) for r in frames.without(rows, F.col("key"), lost, n_bits).collect())
        assert found == Counter(tuple(r) for r in rows.collect() if r["key"] not in (1, 3))
    none = frames.staged(spark.createDataFrame([], "lost int"), "lost")
    assert frames.without(rows, F.col("key"), none).count() == 200


# 5: decontamination

def test_leaks_of_items_of_every_length(spark, docs, monkeypatch):
    """Items much shorter and much longer than a window, given word for word and paraphrased in long documents; the basis is fitted to a sample."""
    monkeypatch.setattr(latent, "FIT_PASSAGES", 400)
    rnd = random.Random(31)
    often = [1 / (k + 2) for k in range(len(WORDS))]

    def text(n):
        return rnd.choices(WORDS, often, k=n)

    items, rows, want = [], [], set()
    for j, n in enumerate([4, 8, 8, 8, 8, 10, 10, 10, 15, 15, 40, 40, 150, 150, 150, 300, 300, 300, 300] * 2):
        item = [w + rnd.choice("aeiou") if rnd.random() < 0.5 else w for w in text(n)]
        items.append((j, " ".join(item)))
        given = item if j % 2 or n < 40 else [w if k % 6 or k >= 0.7 * n else "instead" for k, w in enumerate(item)]
        rows.append((j, " ".join(text(rnd.randrange(200, 400)) + given + text(rnd.randrange(200, 400)))))
        want.add((j, j))
    rows += [(1000 + k, " ".join(text(300))) for k in range(300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in latent.contaminated(docs(rows), bench).collect()}
    assert want - got == set()
    block = latent.block_of(items)
    number = {int(h): k for k, h in enumerate(block.vocabulary)}
    for i, t in rows:  # and nothing that the check around any window accepts is missing, nothing else is there
        words = [number.get(int(h), -1) for h in latent._hashes(t)]
        for j, (item, answer) in enumerate(zip(block.items, block.answers, strict=True)):
            if sum((Counter(item.tolist()) & Counter(words)).values()) >= 0.6 * len(item):
                found = any(latent.leak(item, answer, words[max(0, at - len(item)):at + latent.WINDOW + len(item)]) for at in range(0, len(words), latent.STRIDE))
                assert found == ((i, block.ids[j]) in got)


def test_the_basis_is_fitted_to_all_passages(spark, docs, monkeypatch):
    monkeypatch.setattr(latent, "FIT_PASSAGES", 1)
    fitted = []
    monkeypatch.setattr(latent, "latent_basis", lambda known, weights, real=latent.latent_basis: (fitted.append(known.count()), real(known, weights))[1])
    rows = [(k, " ".join(random.Random(k).choices(WORDS, k=40))) for k in range(60)]
    bench = spark.createDataFrame([(1, " ".join(WORDS[:20]))], "item_id bigint, text string")
    latent.contaminated(docs(rows), bench).count()
    assert fitted == [60]


def test_sums_of_words_that_stand_together(spark, monkeypatch):
    """A'(A M) and (A M)'(A M) against the dense matrix of strides, words that stand twice in a stride and parts that are given out early included."""
    monkeypatch.setattr(latent, "_PAIRS", 200)
    monkeypatch.setattr(latent, "_CHUNK", 300)
    rng, size = np.random.default_rng(4), 30
    rows, dense = [], []
    for k in range(90):
        n = int(rng.integers(0, 70))
        at = np.sort(rng.choice(n, int(rng.integers(0, n + 1)), replace=False)).astype(np.int32)
        word = (rng.integers(0, size, len(at)) * rng.random(len(at))).astype(np.int32)
        rows.append((k, n, at.tobytes(), word.tobytes()))
        for s in range(max(1, -(-n // latent.STRIDE))):
            dense.append(np.bincount(word[at // latent.STRIDE == s], minlength=size))
    batch = pa.RecordBatch.from_pylist([dict(zip(("doc_id", "n_words", "at", "word"), r)) for r in rows])
    a, m = np.array(dense, float), rng.standard_normal((size, 7))
    for passages in (20, 10_000):
        together = list(latent._together(size, passages)(iter([batch])))
        assert len(together) > 1
        assert np.allclose(latent._applied(iter(together), m.astype(np.float32), size), a.T @ (a @ m), rtol=1e-4, atol=1e-3)


# 3: substring dedup

def test_passages_with_parts_that_stand_twice():
    rng = np.random.default_rng(5)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 50_000, n)]

    def found(a, b):
        return windows.matching_passages(windows.shingles(" ".join(a)), windows.shingles(" ".join(b)), 46, 0.8)

    line, rest, far = prose(25), prose(40), prose(8)
    a, b = prose(30) + line + rest + prose(20), prose(10) + line + prose(80) + line + rest + prose(30)
    assert [p[:4] for p in found(a, b)] == [(30, 90, 115, 175)] and [p[:4] for p in found(b, a)] == [(115, 175, 30, 90)]
    one, two = prose(60), prose(60)
    assert [p[:4] for p in found(one + far + two, one + prose(8) + two + prose(300) + far)] == [(0, 123, 0, 123)]
    # Against all windows of one size, over texts of lines that repeat, whole or edited.
    linked = 0
    for _ in range(60):
        lines = [prose(int(n)) for n in rng.integers(8, 30, 6)]
        order, texts = rng.integers(0, 6, 7).tolist(), []
        for _ in range(2):
            text = []
            for k in order:
                text += lines[k] if rng.random() < 0.8 else [w if rng.random() < 0.9 else "x" for w in lines[k]]
                text += prose(int(rng.integers(1, 25))) if rng.random() < 0.3 else []
            texts.append(text)
            order = [*rng.integers(0, 6, 2).tolist(), *order[int(rng.integers(0, 4)):]]
        left, right = (windows.shingles(" ".join(t)) for t in texts)
        sets = [[frozenset(x[k:k + 46].tolist()) for k in range(len(x) - 45)] for x in (left, right)]
        like = any(len(x & y) >= 0.8 * len(x | y) and {left[p], left[p + 45], right[q], right[q + 45]} <= x & y  # ends that both have
                   for p, x in enumerate(sets[0]) for q, y in enumerate(sets[1]))
        got = found(*texts)
        assert got or not like
        linked += like
        for i, k, j, m, score in got:
            x, y = set(left[i:k + 1].tolist()), set(right[j:m + 1].tolist())
            assert min(k - i, m - j) >= 45 and score >= 0.8 and abs(len(x & y) / len(x | y) - score) < 1e-9
    assert linked


def test_pairs_behind_a_phrase_of_all(spark, docs):
    """Most of what two documents share stands in all documents; the class of each is that of its one partner."""
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 50_000, n))

    phrase = prose(44)
    rows = [(i, f"{prose(60)} {phrase} {prose(60)}") for i in range(300)]
    for k in range(30):
        before, after = prose(k % 13), prose(12 - k % 13)
        rows += [(1000 + k, f"{prose(50)} {before} {phrase} {after} {prose(50)}"), (2000 + 7 * k % 30, f"{prose(70)} {before} {phrase} {after} {prose(30)}")]
    lines = [prose(30) for _ in range(6)]  # each line is in ten documents, two of them in a row in two
    orders = list(itertools.combinations(range(6), 2))
    for k, order in enumerate(orders):
        for i in (3000 + k, 4000 - k):
            rows.append((i, "\n".join([prose(40), *(lines[x] for x in order), prose(40)])))
    frame = docs(rows)
    classes = {r["doc_id"]: r["class_id"] for r in windows.passage_classes(frame, windows.repeated_passages(frame)).collect()}
    assert {2000 + 7 * k % 30: classes[2000 + 7 * k % 30] for k in range(30)} == {2000 + 7 * k % 30: 1000 + k for k in range(30)}
    assert [classes[4000 - k] for k in range(len(orders))] == [3000 + k for k in range(len(orders))]
    assert all(classes[i] == i for i in range(300))


def test_edits_at_the_joint_of_two_common_lines(spark, docs):
    """Every line stands in a hundred documents; two in a row, edited where they meet, in one pair of documents each."""
    rng = np.random.default_rng(17)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 50_000, n)]

    lines = [prose(30) for _ in range(12)]
    rows = [(100 * n + k, prose(40) + line + prose(40)) for n, line in enumerate(lines) for k in range(100)]
    orders = list(itertools.combinations(range(12), 2))[:60]
    for k, (x, y) in enumerate(orders):
        edited = [*lines[x], "changed", *lines[y][1:]] if k % 2 else [*lines[x][:-1], "changed", *lines[y]]
        rows += [(3000 + k, prose(40) + lines[x] + lines[y] + prose(40)), (5000 - k, prose(30) + edited + prose(50))]
    for k in range(60):  # brute force: each pair is a passage, by its shingle sets
        a, b = ({tuple(r[j:j + 5]) for j in range(40 if i else 30, (100 if i else 90) - 4)} for i, r in
                ((1, rows[1200 + 2 * k][1]), (0, rows[1201 + 2 * k][1])))
        assert len(a & b) >= 0.8 * len(a | b)
    frame = docs([(i, " ".join(t)) for i, t in rows])
    classes = {r["doc_id"]: r["class_id"] for r in windows.passage_classes(frame, windows.repeated_passages(frame)).collect()}
    assert [classes[5000 - k] for k in range(60)] == [3000 + k for k in range(60)]
    assert all(classes[i] == i for i in range(1200))


def test_edited_passages_of_seeds_that_many_documents_share(spark, docs):
    """Every line stands in dozens of documents and every two in a row in ten, each edited elsewhere: no seed and no chain of seeds has
    few documents, and no 50 words are equal."""
    rng = np.random.default_rng(29)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 50_000, n)]

    lines = [prose(30) for _ in range(6)]
    rows = [(100 * n + k, prose(40) + line + prose(40)) for n, line in enumerate(lines) for k in range(60)]
    orders = list(itertools.combinations(range(6), 2))
    for g, (x, y) in enumerate(orders):
        for k in range(10):
            edited = lines[x] + lines[y]
            edited[26 + k % 8] = f"changed{g}of{k}"
            rows.append((1000 + g + 100 * k, prose(30 + k) + edited + prose(40)))
    frame = docs([(i, " ".join(t)) for i, t in rows])
    passages = windows.repeated_passages(frame)
    classes = {r["doc_id"]: r["class_id"] for r in windows.passage_classes(frame, passages).collect()}
    texts = {i: [tuple(t[j:j + 5]) for j in range(len(t) - 4)] for i, t in rows}
    # Brute force over the edited stretches: who is similar to whom, and what hangs together by that.
    alike = {i: i for i in texts}
    for g in range(len(orders)):
        mine = [(1000 + g + 100 * k, set(texts[1000 + g + 100 * k][30 + k:30 + k + 56])) for k in range(10)]
        for (i, a), (j, b) in itertools.combinations(mine, 2):
            if len(a & b) >= 0.8 * len(a | b):
                alike[j] = min(alike[j], alike[i])
        assert all(alike[i] == 1000 + g for i, _ in mine)
    assert classes == alike
    for r in passages.collect():
        a, b = (set(texts[r[f"{s}"]][r[f"start_{s}"]:r[f"end_{s}"] - 4]) for s in "ab")
        assert len(a & b) >= 0.8 * len(a | b) - 1e-9


def test_pairs_left_out_by_the_count_of_common_shingles():
    """No pair with a passage is left out before verification, repeats or none."""
    rnd = random.Random(23)
    left_out = 0
    for _ in range(400):
        pool = [rnd.randrange(1000) for _ in range(rnd.choice([6, 40, 400]))]
        base = [rnd.choice(pool) for _ in range(rnd.randrange(30, 120))]
        other = [x if rnd.random() > rnd.choice([0.02, 0.1, 0.5]) else rnd.randrange(1000) for x in base][rnd.randrange(20):]
        a, b = (np.array(x, np.uint32) for x in (base, other))
        may = windows._may_match(a, b, 46, 0.8)
        left_out += not may
        assert may or not windows.matching_passages(a, b, 46, 0.8)
    assert left_out > 20


def test_proposals_that_the_different_shingles_do_not_allow(monkeypatch):
    """They are not tried one by one, and every passage is found as before."""
    rnd, longest, counted = random.Random(29), windows._longest, [0, 0]
    count_nonzero = np.count_nonzero

    def without(*args):
        return longest(*args[:10])

    def counting(*args, **kwargs):
        counted[way] += 1
        return count_nonzero(*args, **kwargs)

    monkeypatch.setattr(windows.np, "count_nonzero", counting)
    for _ in range(120):
        lines = [[rnd.randrange(1000) for _ in range(rnd.randrange(3, 12))] for _ in range(40)]
        base, other = ([x for _ in range(50) for x in rnd.choice(lines[k:k + 30])] for k in (0, 8))
        a, b = (np.array(x, np.uint32) for x in (base, other))
        found = []
        for way, tried in enumerate((without, longest)):
            monkeypatch.setattr(windows, "_longest", tried)
            found.append(windows.matching_passages(a, b, 46, 0.8))
        assert found[0] == found[1]
        before, shared = windows._earlier(a, b)
        begin = np.array([rnd.randrange(len(a)) for _ in range(20)])
        end = np.array([rnd.randrange(x, len(a)) for x in begin])
        every, both = windows._different(before, shared, begin, end)
        parts = [set(base[x:y + 1]) for x, y in zip(begin, end, strict=True)]
        assert (every.tolist(), both.tolist()) == ([len(x) for x in parts], [len(x & set(other)) for x in parts])
    assert counted[1] < counted[0] / 2, counted


def test_pairs_that_share_a_repeated_word_are_not_searched():
    """Stretches of a word over and over share one shingle; without another no passage of 46 places is possible, and none with one is left out."""
    rnd = random.Random(37)

    def text(words, most):
        return [x for w in words for x in [w] * rnd.randrange(5, most)]

    lefts, rights, alone = [], [], []
    for _ in range(300):
        words = rnd.sample(range(40), 8)
        a, b = text([1000, *words], 40), text([*rnd.sample(range(100, 140), 8), 1000], 40)
        if rnd.random() < 0.3:
            b += [x if rnd.random() < 0.95 else 7 for x in a]
        if rnd.random() < 0.2:
            a, b = a + [1000] * 60, [1000] * 60 + b
        x, y = (windows.shingles(" ".join(map(str, t))).astype(np.uint32) for t in (a, b))
        lefts, rights = [*lefts, x], [*rights, y]
        alone.append(windows._may_match(x, y, 46, 0.8))
    able = windows._able(lefts, rights, 46, 0.8)
    assert able.tolist() == alone
    found = [bool(windows.matching_passages(x, y, 46, 0.8)) for x, y in zip(lefts, rights, strict=True)]
    assert all(a or not f for a, f in zip(alone, found, strict=True)) and 60 < sum(found) < 200
    assert sum(alone) < 1.5 * sum(found)


def test_places_of_crowded_seeds_meet_in_one_task_or_by_joins(spark):
    """Groups that fit in memory and larger ones give the same pairs."""
    rng = np.random.default_rng(12)
    rows = []
    for key in range(30):
        pool = rng.integers(-(1 << 62), 1 << 62, int(rng.choice([8, 60, 400])))
        for doc in rng.choice(90, int(rng.integers(1, 25)), replace=False).tolist():
            grams = np.unique(rng.choice(pool, min(len(pool), 50), replace=False)).tolist()
            lo = int(rng.integers(0, 300))
            rows.append((key, doc, lo, lo + 14, int(rng.integers(1, 12)), grams))
    regions = spark.createDataFrame(rows, "key bigint, doc_id bigint, lo int, hi int, need int, grams array<bigint>").cache()
    state = spark.createDataFrame([(d, d % 3, [(0, 150 + d)]) for d in range(90)], "id bigint, class_id bigint, passages array<struct<start:int,end:int>>")
    pair = windows._pair(50, 5)
    # A join by the key before them, as in the operator, must not tear the groups apart.
    sizes = regions.groupBy("key").agg(F.count("*").alias("n"))
    known = windows._known(regions, state, "key", "need", "grams").join(sizes.where("n <= 512"), "key", "left_semi")
    for way in (windows._with_first, windows._all_pairs):
        want = way(windows._known(windows._rarest(regions), state, "key", "gram"), pair).distinct().collect()
        got = windows._meetings(known, 100, 5, way is windows._with_first).distinct().collect()
        assert set(got) == set(want) and len(got) == len(want) > 100


def test_crowded_groups_of_any_size(spark, docs, monkeypatch):
    rng = np.random.default_rng(30)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 50_000, n)]

    lines, rows = [prose(30) for _ in range(2)], []
    rows = [(100 * n + k, prose(40) + line + prose(40)) for n, line in enumerate(lines) for k in range(20)]
    for k in range(12):
        edited = lines[0] + lines[1]
        edited[26 + k % 8] = f"changed{k}"
        rows.append((1000 + k, prose(30 + k) + edited + prose(40)))
    frame, results = docs([(i, " ".join(t)) for i, t in rows]), []
    for grouped in (512, 1):
        monkeypatch.setattr(windows, "GROUPED", grouped)
        results.append({tuple(r) for r in windows.repeated_passages(frame).collect()})
    assert results[0] == results[1] and len(results[0]) >= 11


def test_runs_by_brute_force():
    """All runs of equal shingles, in one block or in many."""
    rng = np.random.default_rng(41)
    for _ in range(150):
        kinds = int(rng.choice([1, 2, 5, 40]))
        left, right = (np.repeat(rng.integers(0, kinds, int(rng.integers(1, 40))), int(rng.integers(1, 4))) for _ in range(2))
        want = []
        for i, j in itertools.product(range(len(left)), range(len(right))):
            if left[i] == right[j] and (not i or not j or left[i - 1] != right[j - 1]):
                n = 1
                while i + n < len(left) and j + n < len(right) and left[i + n] == right[j + n]:
                    n += 1
                want.append((i, j, n))
        for most in (1, 7, 60, 4_000_000):
            blocks = list(windows._all_runs(left, right, most))
            assert sorted(x for b in blocks for x in zip(*(c.tolist() for c in b), strict=True)) == want
            assert len(blocks) == 1 or most < 4_000_000


def test_passage_of_a_line_that_stands_everywhere():
    """A line stands 451 times on both sides, over four million pairs of places; only its last place on both sides is part of a passage."""
    rng = np.random.default_rng(1)

    def prose(n):
        return rng.integers(0, 1 << 31, n).tolist()

    line, rest = prose(25), prose(40)
    left, right = ([x for _ in range(450) for x in line + prose(8)] + prose(n) + line + rest + prose(20) for n in (30, 70))
    left, right = (windows.shingles(" ".join(map(str, x))) for x in (left, prose(30) + right))
    assert windows.matching_passages(left, right, 46, 0.8) == [(14880, 14940, 14950, 15010, 1.0)]


# 9: license notices

def test_every_notice_of_several_in_a_row():
    def found(text):
        return [(h.label, h.first_word, h.end_word, h.edits) for h in notices.notice_hits(notices.normalised(text))]

    assert found("x all rigts reserved and all rights reserved y") == [("all-rights-notice", 1, 4, 1), ("all-rights-notice", 5, 8, 0)]
    mit = ["released under the mit license", "relesed under teh mit license", "released under the mit licence", "relased under the mit license"]
    for order in itertools.permutations(mit):
        got = found(" ".join(order))
        assert [x[:3] for x in got] == [("mit-notice", 5 * k, 5 * k + 5) for k in range(4)]
        assert [x[3] == 0 for x in got] == [x == mit[0] for x in order]


# 4 and 9: long texts

def _seconds(fn, text):
    best = float("inf")
    for _ in range(3):
        began = time.perf_counter()
        fn(text)
        best = min(best, time.perf_counter() - began)
    return best


def test_scans_of_long_texts_take_linear_time():
    for unit in ("mit license ", "all rigts reserved ", "all rights reserved ", "general public ", "spdx license identifer x "):
        small, large = (_seconds(notices.scan_text, unit * (n // len(unit))) for n in (15_000, 60_000))
        assert large < 8 * small + 0.2, unit
    for unit in ("eyJaaaaaaaa-", "eyJaaaaaaaa.", "token=", "-----BEGIN A ", "abcdef0123", "ghp_a", "a://b:"):
        small, large = (_seconds(lambda t: blob_ledger.spans_of(t, blob_ledger.RULES), unit * (n // len(unit))) for n in (250_000, 1_000_000))
        assert large < 8 * small + 0.2, unit


def test_notices_far_apart_and_in_long_rows():
    rnd = random.Random(8)
    line, want = [], []
    for k in range(400):
        label, said = rnd.choice([("all-rights-notice", "all rigts reserved"), ("spdx-tag", "spdx license identifier"), (None, "some other words"), (None, "reserved rights")])
        if label:
            want.append((sum(len(x.split()) for x in line), label))
        line.append(said)
    found = [(h.first_word, h.label) for h in notices.notice_hits(" ".join(line)) if h.label in ("all-rights-notice", "spdx-tag")]
    assert found == want


# chat formatting

def test_every_reply_is_an_example_written_out_and_read_back(spark, monkeypatch):
    rnd = random.Random(31)
    bits = ["[INST]", "[/INST]", " [/INST]", "<s>", "</s>", "<", "[", "\\", "<<SYS>> ", " <</SYS>>", "[ROLE]", "[/ROLE] ", " [/TEXT]", "\n", " ", "x", "é😀"]
    rows = [(c if c else None, t, rnd.choice(["user", "assistant", "system", "tool", "", "a[/ROLE] b"]),
             "".join(rnd.choices(bits, k=rnd.randrange(8)))) for c in range(60) for t in range(rnd.randrange(1, 12))]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    formatted = chat.format_conversations(frame).cache()
    whole, replies = {}, Counter()
    for r in sorted(formatted.collect(), key=lambda r: r["position"]):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["segment"]
        replies[r["conv_id"]] += r["role"] == "assistant"
    found = chat.expanded(formatted).collect()
    written = [r for r in found if r["target"] is not None]
    assert Counter(r["conv_id"] for r in written) == +replies
    for r in written:
        assert whole[r["conv_id"]].startswith(r["text"]) and r["text"][:r["loss_start"]].endswith("<s>") and r["text"][r["loss_end"]:] == "</s>"
    longest = {c: max((r["text"] for r in written if r["conv_id"] == c), key=len, default="") for c in whole}
    for c, text in whole.items():
        assert [r["text"] for r in found if r["conv_id"] == c and r["target"] is None] == ([text[len(longest[c]):]] if text != longest[c] else [])
    # The same digests as from the segments themselves.
    by_text, by_segment = (Counter(tuple(r) for r in chat.digests(x).collect())
                           for x in (chat.read_back_examples(chat.expanded(formatted)), chat.read_back(formatted)))
    assert by_text == by_segment and len(by_text) == 60
    # The query takes this way.
    given = []
    monkeypatch.setattr(chat, "read_back_examples", lambda x, f=chat.read_back_examples: given.append(x) or f(x))
    query = queries.op2_chat_format(spark, SF).collect()
    assert given[0].where("target is not null").count() == sum(r["n_examples"] for r in query) > 0
    assert given[0].where("target is not null").agg(F.sum(F.length("text"))).first()[0] == sum(r["example_chars"] for r in query)
