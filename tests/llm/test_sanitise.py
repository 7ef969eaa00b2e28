"""Sanitisation against plain Python that follows the contract's words and the formulas."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from daypanel.llm import queries, sanitise

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def luhn(d):
    odd = [int(x) for x in d[-1::-2]]
    even = [sum(divmod(2 * int(x), 10)) for x in d[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def base(text):
    """(start, order, kind, end, entity, gap before, gap after) of all base findings; gaps reach to the next match of the kind, valid or not."""
    out = []
    for order, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        matches = list(pattern.finditer(text))
        for k, m in enumerate(matches):
            value, digits = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                before = text[matches[k - 1].end() if k else 0:m.start()]
                after = text[m.end():matches[k + 1].start() if k + 1 < len(matches) else len(text)]
                entity = value.lower() if kind in ("email", "ip") else digits
                out.append((m.start(), order, kind, m.end(), f"{kind}:{entity}", before, after))
    return sorted(out)


def general(word):
    return word[:(len(word) + 1) // 2] + "*"


def brute_terms(texts, support, disclosed):
    both, holders, spread = Counter(), Counter(), Counter()
    for text in texts:
        pairs = set()
        for *_, entity, before, after in base(text):
            near = WORD.findall(before)[-sanitise.REACH:] + WORD.findall(after)[:sanitise.REACH]
            pairs |= {(entity, f) for w in near for f in (w.lower(), general(w.lower()))}
        both.update(pairs)
        holders.update({x[4] for x in base(text)})
        words = {w.lower() for w in WORD.findall(text)}
        spread.update(words)
        spread.update({general(w) for w in words})
    n = len(texts)
    hit = set()
    for (e, f), c in both.items():
        if c >= support and holders[e] < n:
            pmi, ic = math.log2(n * c / (holders[e] * spread[f])), math.log2(n / holders[e])
            assert abs(pmi - disclosed * ic) > 1e-9
            if pmi >= disclosed * ic:
                hit.add((e, f))
    out = defaultdict(lambda: "general")
    for e, f in hit:
        if not f.endswith("*"):
            out[f] = "removed" if (e, general(f)) in hit or out[f] == "removed" else "general"
    return dict(out)


def brute(texts, support=sanitise.SUPPORT, disclosed=sanitise.DISCLOSED):
    texts = [t or "" for t in texts]
    terms = brute_terms(texts, support, disclosed)
    found = []
    for text in texts:
        spans = [x[:4] for x in base(text)]
        for m in WORD.finditer(text):
            kind = terms.get(m.group().lower())
            if kind:
                spans.append((m.start(), sanitise.ORDER.index(kind), kind, m.end()))
        found.append(sorted(spans))
    return found


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *map(str, r)))


def corpus(rnd, n=160):
    words = "the of and a house river green walked slowly under old bridge Zebra straße été 42".split()
    bits = ["a@b.c", "x.y+z@mail-1.example.com", "a@b.c_d@e.f", "@@x@y", "a..b@c.d.e.", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.0255", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "1234567890123", "0000 0000 0000", "12-34", "+1 (499) 555-6503", "+49.", "+1234567890123456", "+1 2", "++44 20 7946 0958)", "é@é.com",
            "\U0001f600", "\n", "9" * 30, "5" * 12, " - ", "%@%.a", "a@b.c-", "1..2.3.4"]
    secret = ["contact quillon at q.von@rare.example.org about the heronmere estate", "heronmere lies behind quillon 's house and heronstone", "quillon again"]
    texts = []
    for _ in range(n):
        t = [rnd.choice(bits) if rnd.random() < 0.2 else rnd.choice(words) for _ in range(rnd.choice([0, 3, 30, 80]))]
        if rnd.random() < 0.15:
            t.insert(rnd.randrange(len(t) + 1), rnd.choice(secret))
        texts.append(rnd.choice(["", " "]).join(t) if rnd.random() < 0.2 else " ".join(t))
    return texts


def test_findings_and_terms(spark, docs):
    for seed in (1, 2):
        texts = corpus(random.Random(seed)) + [None, "", "same a@b.c", "same a@b.c", "x " * 1000, "İstanbul a@b.c ΑΣ"]
        rows = [(None if k == 3 else k % 50, t) for k, t in enumerate(texts)]
        want = by_row([(i, [tuple(x) for x in spans]) for (i, _), spans in zip(rows, brute(texts))])
        found = sanitise.scan(docs(rows), text="text")
        assert by_row([(r["doc_id"], [tuple(x) for x in r["findings"]]) for r in found.collect()]) == want
        assert found.columns == [*docs(rows).columns, "findings"]
        kinds = {x[2] for _, spans in want for x in spans}
        assert {"email", "ip", "card", "phone", "removed"} <= kinds


def test_a_term_is_generalised_where_its_general_form_tells_nothing(spark, docs):
    rows = [(k, f"write to me@there.org near wolfgate number {k}") for k in range(4)] + [(10 + k, f"wolfhound {k} and wolfram too, a wolfpack") for k in range(40)]
    rows += [(60 + k, f"other text {k} write number near to") for k in range(60)] + [(200, "only wolfgate, no address")]
    found = {r["doc_id"]: [(x["kind"], x["start"], x["end"]) for x in r["findings"]] for r in sanitise.scan(docs(rows)).collect()}
    assert found[200] == [("general", 5, 13)] and ("general", 27, 35) in found[0] and found[10] == [] and found[61] == []
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs(rows)).collect()}
    assert clean[200] == "only wolf*, no address" and clean[0] == "write to <email> near wolf* number 0" and clean[10] == rows[4][1]


def test_sanitised_text_of_overlapping_and_wide_spans(spark, docs):
    rows = [(1, "\U0001f600 +4111 1111 1111 1111 x"), (2, None), (3, "nothing"), (4, "a@b.c1.2.3.4"), (5, "1.2.3.4 and 5.6.7.8")]
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs(rows)).collect()}
    assert clean == {1: "\U0001f600 +<card> x", 2: None, 3: "nothing", 4: "<email>", 5: "<ip> and <ip>"}


def test_digest_of_the_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = []
    for (i, _), spans in zip(rows, brute([t for _, t in rows])):
        listed = [",".join(f"{k}:{a}:{b}" for a, _, k, b in some) for some in ([x for x in spans if x[1] < 4], spans)]
        counts = [sum(x[2] == k for x in spans) for k in ("email", "ip", "card", "phone")]
        want.append((i, *counts, hashlib.sha256(listed[0].encode()).hexdigest(), listed[1]))
    assert sorted(tuple(r) for r in queries.op11_sanitise(spark, SF).collect()) == sorted(want)


def test_no_python_on_the_main_path(spark, capsys):
    queries.op11_sanitise(spark, SF).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_empty_table(spark, docs):
    empty = docs([(1, "x")]).where("false")
    assert sanitise.scan(empty).collect() == [] and sanitise.sanitised(empty).collect() == []


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 300_000, "1" * 300_000, "a." * 150_000, "1.1" * 100_000, "x@" * 150_000, "+" * 300_000, "+1" * 150_000, "1 " * 150_000, "a@b.c " * 50_000, "+1" + "-" * 300_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    found = {r["doc_id"]: r["n"] for r in sanitise.scan(table, keep=["doc_id"]).select("doc_id", F.size("findings").alias("n")).collect()}
    assert found[8] == 50_000 and found[0] == 0 and found[5] == 0
