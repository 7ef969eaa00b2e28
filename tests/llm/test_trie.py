"""The prefix trie against tries built turn by turn in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from daypanel.llm import prefix_trie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """rows: (conv_id, turn, role, text) without ties of a turn."""
    own = defaultdict(list)
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100
        rebuilt = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[rebuilt].append(c)
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        mine = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += mine
    return sorted((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n in members) if members else None


def got(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.select(*NAMES).collect())


def test_trie_of_the_given_conversations(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_prefix_trie(spark, sf)) == brute(rows)


def test_trie_cases(spark):
    rnd = random.Random(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(250, 262)]:  # 200 is absent, 0 and 100 are there
        for t in range(rnd.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["", None, "a", "öß", "a\U0001f600"])))
    rows += [(300, t, "user", "same") for t in range(150)]  # a long chain
    rows += [(c, t, "user", "same") for c in range(301, 330) for t in range(150 - 3 * (c - 300))]  # and others that leave it
    rows += [(400, None, "user", "first"), (400, -3, "user", "then"), (None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(500 + k, 0, "user", "hot") for k in range(60)]
    assert any(zlib.crc32(str(c).encode()) % 6 == 0 for c in range(300, 330))
    rnd.shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit(1), "kids": F.lit("x"), "depth": F.lit(2), "h1": F.lit(0)}).repartition(7)
    assert got(prefix_trie.trie(table)) == brute(rows)


def test_trie_repeated_rows_and_empty_table(spark):
    rows = [(100, 0, "user", "x"), (100, 0, "user", "x"), (100, 1, "user", "y")]
    found = got(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)))
    assert [r[:2] for r in found] == [(100, d) for d in range(len(found))] and len(found) == 4
    empty = got(prefix_trie.trie(spark.createDataFrame([], SCHEMA)))
    assert empty == [(None, 0, None, 0, 0, 1, 0, hashlib.sha256(b"").hexdigest())]


def test_sums_of_deep_and_broad_trees(spark):
    rnd = random.Random(6)
    parent = {0: None}
    for k in range(1, 700):
        parent[k] = k - 1 if k < 300 else rnd.randrange(k) if k % 3 else k - 1
    weight = {k: rnd.randrange(50) for k in parent}
    total = dict(weight)
    for k in range(699, 0, -1):
        total[parent[k]] += total[k]
    rows = [((k, 0), None if p is None else (p, 0), weight[k], 1) for k, p in parent.items()]
    tree = spark.createDataFrame(rows, f"node {prefix_trie.NODE}, parent {prefix_trie.NODE}, w bigint, n bigint")
    sums = {r["node"]["conv_id"]: (r["w"], r["n"]) for r in prefix_trie.subtree_sums(tree, ["w", "n"]).collect()}
    size = {k: 1 for k in parent}
    for k in range(699, 0, -1):
        size[parent[k]] += size[k]
    assert sums == {k: (total[k], size[k]) for k in parent}


def test_sql_counterpart(spark):
    from tests.compare import connect, differences

    sf = "/root/testdata/sf0.01"
    assert differences(queries.op12_prefix_trie(spark, sf), connect(sf), queries.ORACLES["op12_prefix_trie"]) == []
