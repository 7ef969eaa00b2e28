"""The contracted results, against plain Python that follows the contract's words."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from daypanel.llm import blob_ledger, chat, golay, notices, queries, rule_ledger

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "a", "a b", "a b c", "Ä É x y ZZ\x1cq", "x " * 3000, "İstanbul ſecret=abcdefgh K"]


def texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows + [(10_000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id here"), (20_000, "same row twice"), (20_000, "same row twice")]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *map(str, r)))


def test_secret_scan(spark, docs):
    rnd = random.Random(3)
    bits = ["password", "Secret", "api_key", "APIKEY", "token", "=", ":", " ", "'", '"', "abc", "0123456789abcdef" * 2, "AKIA", "Q" * 17, "token=token: abcdefgh",
            "é", "\n", "-", "g", "ſecret=abcdefgh", "aKIA" + "A" * 20]
    rows = texts(spark) + [(30_000 + k, "".join(rnd.choice(bits) for _ in range(rnd.randrange(30)))) for k in range(200)]
    kinds = (("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
             ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24))

    def expected(text):
        found = [(m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(kinds)
                 for m in p.finditer(text or "") if len(m.group(g)) >= least]
        listed = ",".join(f"{n}:{a}:{b}" for a, _, n, b in sorted(found))
        return (*[sum(x[1] == k for x in found) for k in range(3)], hashlib.sha256(listed.encode()).hexdigest())

    found = blob_ledger.findings(docs(rows), blob_ledger.scan(docs(rows)))
    base = F.filter("findings", lambda x: x["kind"].isin("assign", "access", "hex"))
    got = [(r["doc_id"], *[sum(x["kind"] == k for x in r["base"]) for k in ("assign", "access", "hex")],
            hashlib.sha256(",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in r["base"]).encode()).hexdigest())
           for r in found.select("doc_id", base.alias("base")).collect()]
    assert by_id(got) == by_id([(i, *expected(t)) for i, t in rows])


def test_simhash(spark, docs):
    rows = texts(spark)
    near = " ".join(f"w{k}" for k in range(400))
    rows += [(40_000 + k, near.replace(f"w{7 * k} ", "changed ")) for k in range(60)]

    def fp(text):
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
        if not words:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in rows]
    at = list(range(len(rows)))

    def top(k):
        while at[k] != k:
            k = at[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                at[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    got = golay.near_duplicates(docs(rows)).select("doc_id", F.hex("fp"), "component_id").collect()
    expected = [(i, f"{f:X}", least.get(top(k))) for k, ((i, _), f) in enumerate(zip(rows, fps, strict=True))]
    assert by_id([tuple(r) for r in got]) == by_id(expected)


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_of_crowded_keys(spark, bits):
    """More near fingerprints than are paired under one key: the exact way for hot keys."""
    rnd = random.Random(bits)
    fps = set()
    for center in (rnd.getrandbits(64) for _ in range(3)):
        walk = center
        for _ in range(150):
            fps.add(walk)
            walk ^= 1 << rnd.randrange(64)
            fps.add(center ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps |= {rnd.getrandbits(64) for _ in range(100)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    frame = spark.createDataFrame([(f,) for f in signed.values()], "fp bigint")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in golay.links(frame, bits).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in edges)

    def classes(pairs):
        at = {f: f for f in fps}

        def top(f):
            while at[f] != f:
                f = at[f]
            return f

        for a, b in pairs:
            at[top(a)] = top(b)
        groups = {}
        for f in fps:
            groups.setdefault(top(f), set()).add(f)
        return {frozenset(g) for g in groups.values()}

    ordered = sorted(fps)
    every = [(a, b) for k, a in enumerate(ordered) for b in ordered[:k] if (a ^ b).bit_count() <= bits]
    assert classes(edges) == classes(every)


def test_codewords():
    """The code's table by brute force over all codewords: those within four flips."""
    import numpy as np

    rnd = random.Random(1)
    generator = 0xC75
    words = []
    for message in range(1 << 12):
        word = 0
        for k in range(12):
            if message >> k & 1:
                word ^= generator << k
        words.append(word)
    for x in (rnd.getrandbits(23) for _ in range(60)):
        near = sorted((x ^ c).bit_count() for c in words)
        reach = 4 if near[0] == 3 else 3
        assert {c >> 11 for c in words if (x ^ c).bit_count() <= reach} == set(golay.codewords(np.array([x]))[0].tolist())


def test_quality_measures(spark, docs):
    rows = texts(spark) + [(50_000, "a b c d e f g h i " * 3), (50_001, "one two\n\none two\n \nx"), (50_002, "w " * 9)]

    def expected(text):
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        windows = {}
        for k in range(len(words) - 7):
            windows.setdefault(tuple(words[k:k + 8]), []).append(k)
        repeated = {w for at in windows.values() if len(at) > 1 for k in at for w in range(k, k + 8)}
        failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated), failed)

    ledger = rule_ledger.ledger(docs(rows))
    got = ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", rule_ledger.fails(rule_ledger.BASE).alias("f"),
                        (~rule_ledger.fails(rule_ledger.PRODUCTION)).alias("kept")).collect()
    assert by_id([tuple(r)[:7] for r in got]) == by_id([(i, *expected(t)) for i, t in rows])
    assert not any(r["f"] and r["kept"] for r in got)


def test_license_scan(spark, docs):
    rows = texts(spark) + [(60_000, "MIT License, mit\nlicense mit-license; the Apache  LICENSE and General.Public.License"),
                           (60_001, "the mit licenses summit license"), (60_002, "Relesed under the MIT Licence here"), (60_003, "mité license mit license")]
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}

    def expected(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(k, label) for p, label in phrases.items() for k in range(len(words)) if tuple(words[k:k + len(p)]) == p]
        firsts = [k for k, _ in at]
        return (len(words), len(at), min(firsts, default=None), max(firsts, default=None), ",".join(sorted({x for _, x in at})))

    got = notices.scan(docs(rows)).collect()
    assert by_id([tuple(r)[:6] for r in got]) == by_id([(i, *expected(t)) for i, t in rows])
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    fuzzy = next(r for r in got if r["doc_id"] == 60_002)
    assert fuzzy["n_base"] == 0 and fuzzy["labels"] == "mit-notice" and 0.8 < fuzzy["score"] < 1
    assert [(h["first_word"], h["end_word"]) for h in fuzzy["hits"]] == [(0, 5)]


def test_fuzzy_notices_against_every_place():
    """Planted edits up to the bound are found; the seeds miss nothing that the pattern finds in the whole text."""
    rnd = random.Random(5)
    for notice in notices.NOTICES:
        for _ in range(10):
            chars = list(notice.words)
            for _ in range(rnd.randrange(notice.errors + 1)):
                chars[rnd.randrange(len(chars))] = rnd.choice(["", "x", "e", "qz"][:3])
            line = notices.normalised("some words before " + "".join(chars) + " and after it")
            assert any(h.label == notice.label for h in notices.notice_hits(line)), (notice, line)


def chat_rows():
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "system", "be <<SYS>> brief"), (1, 1, "user", said), (1, 2, "assistant", r"[\INST] <\/s> \[/ROLE]"), (1, 3, "user", None),
            (1, 4, "assistant", ""), (2, 0, "tool[/ROLE]", "x [/TEXT]\ny"), (2, 1, None, "é😀"), (3, 0, "assistant", "only"), (3, 0, "assistant", "only"),
            (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (4, None, "user", "no turn"), (4, 2, "assistant", "a" * 5000)]
    rows += [(5, k, "assistant" if k % 2 else "user", f"turn {k} " + "<s>" * (k % 3)) for k in range(300)]
    return rows


def test_chat_digests(spark):
    rows = chat_rows()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segment", F.lit(1)).repartition(4)
    formatted = chat.format_conversations(frame).cache()
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(formatted)).collect()}
    assert len(got) == 6
    for conv in {r[0] for r in rows}:
        mine = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv))
        replies = "".join(t for _, r, t in mine if r == "assistant")
        r = got[conv]
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in mine).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"]) == (len(mine), len(replies))
        assert r["loss_sha256"] == hashlib.sha256(replies.encode()).hexdigest()
    # Every example: the context before its reply, and the loss mask on the reply alone.
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: r["position"]):
        assert r["start"] == len(whole.get(r["conv_id"], ""))
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["segment"]
        assert r["end"] == len(whole[r["conv_id"]])
    wanted = chat.examples(formatted).where("conv_id in (1, 3, 5) and target < 20")
    for e in chat.example_texts(formatted, wanted).collect():
        assert e["text"] == whole[e["conv_id"]][:e["chars"]]
        assert e["text"][:e["loss_start"]].endswith("<s>") and e["text"][e["loss_end"]:] == "</s>"
    assert sum(r["n_examples"] for r in got.values()) == sum(role == "assistant" for _, _, role, _ in rows)


def test_queries_run_and_name_the_contracted_columns(spark):
    wanted = {
        "op2_chat_format": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
        "op4_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
        "op7_simhash": {"doc_id", "fingerprint", "component_id"},
        "op8_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op9_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    }
    for name, columns in wanted.items():
        frame = queries.QUERIES[name](spark, SF)
        assert columns <= set(frame.columns), name
        assert frame.count() > 0
