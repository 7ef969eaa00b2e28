"""Conversation prefix trie with totals by parallel tree contraction.

Every distinct sequence of first turns of a conversation is a node; the empty sequence is the root.  The trie is never held anywhere: a
prefix is a pair of 64-bit running sums over the hashes of its turns, so that all prefixes of all conversations are rows of one table.

1. :func:`prefixes` sorts the turns by range, which spreads a long conversation over tasks, and adds up ``hash * base ** place`` over the whole
   table.  A prefix's sum is the difference of two such sums, shifted to its own start; per partition one row goes through the driver.
2. :func:`nodes` groups equal prefixes.  A node is named by its smallest member and its depth.
3. :func:`subtree_sums` contracts the tree in rounds.  *Compress*: along chains of nodes with one child each node learns, by pointer
   doubling, the sum down to the chain's end and is taken out.  *Rake*: the leaves are final and are added to their parents.  Since
   every node that is left after a compress has two children or none, a rake takes at least half of them.  Then the rounds are re-expanded, last one
   first: a node taken out of a chain has its sum plus the total of the chain's end.

Every round is cut by a table in the shared scratch folder; the driver sees counts and the rows per partition of step 1 only.  Parents of many
children and prefixes of many conversations are summed inside tasks first.

Defined cases.  Rows without a ``conv_id`` belong to no conversation and are left out.  A null role or text is empty.  Turns are ordered
by ``turn``, null first; equal ``turn`` values by the hashes of role and text, so repeated rows follow each other.  Other columns are ignored.  An
empty table has the root only, without a member: its ``conv_id`` is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm.frames import staged
from daypanel.session import durable

_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_KEY = ["depth", "k1", "k2"]
NODE = "struct<conv_id:bigint,depth:bigint>"


# --- 1. prefixes ---------------------------------------------------------------------------------

def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, k1, k2, p1, p2, chars``: every turn with the key of the prefix that ends with it, its parent's key, and its code points."""
    said = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = said.select("conv_id", "turn", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role").alias("h2"),
                         F.length("text").cast("bigint").alias("chars"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("h1").asc(), F.col("h2").asc()]
    fixed = durable(hashed.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("part", F.spark_partition_id())
    pieces = fixed.mapInArrow(_piece, "part int, n bigint, s1 bigint, s2 bigint, first_conv bigint, last_conv bigint, "
                                      "last_at bigint, l1 bigint, l2 bigint").collect()  # one row per partition
    starts = _starts(sorted(pieces, key=lambda r: r["part"]))
    shared = fixed.sparkSession.sparkContext.broadcast(starts)
    schema = "conv_id bigint, pos bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, chars bigint"
    return fixed.mapInArrow(_keyed(shared), schema)


def _powers(base: int, first: int, n: int) -> np.ndarray:
    """``base ** first, base ** (first + 1), ...`` modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = pow(base, first, 1 << 64)
    return np.cumprod(out, dtype=np.uint64)


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _running(batches: Iterator[pa.RecordBatch], at: int, sums: list[int]) -> Iterator[tuple]:
    """Per batch: its conversations, the place of its first row, and both running sums *before* and *after* each row."""
    for batch in batches:
        conv, h1, h2 = _columns(batch, "conv_id", "h1", "h2")
        if not len(conv):
            continue
        both = []
        for k, h in enumerate((h1, h2)):
            run = np.zeros(len(conv) + 1, np.uint64)
            np.cumsum(h.view(np.uint64) * _powers(_BASES[k], at, len(conv)), out=run[1:])
            both.append(run + np.uint64(sums[k]))
        yield batch, conv, at, both
        at += len(conv)
        sums = [int(run[-1]) for run in both]


def _piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: a partition's length and sums, its first and last conversation, and where the last one starts."""
    row = None
    for batch, conv, at, (r1, r2) in _running(batches, 0, [0, 0]):
        if row is None:
            row = {"part": int(_columns(batch, "part")[0][0]), "first_conv": int(conv[0]), "last_conv": int(conv[0]), "last_at": 0, "l1": 0, "l2": 0}
        begins = np.flatnonzero(conv[1:] != conv[:-1]) + 1
        if conv[0] != row["last_conv"]:
            begins = np.concatenate([[0], begins])
        if len(begins):
            b = int(begins[-1])
            row |= {"last_conv": int(conv[b]), "last_at": at + b, "l1": int(r1[b]), "l2": int(r2[b])}
        row |= {"n": at + len(conv), "s1": int(r1[-1]), "s2": int(r2[-1])}
    if row:
        signed = {k: (v - (1 << 64) if k in ("s1", "s2", "l1", "l2") and v >> 63 else v) for k, v in row.items()}
        names = ["part", "n", "s1", "s2", "first_conv", "last_conv", "last_at", "l1", "l2"]
        yield pa.RecordBatch.from_arrays([pa.array([signed[n]], pa.int32() if n == "part" else pa.int64()) for n in names], names)


def _starts(pieces: list) -> dict[int, tuple]:
    """part -> place and sums before its first row, and the same before the conversation that its first row belongs to."""
    out, at, sums, last, begun = {}, 0, [0, 0], None, (0, (0, 0))
    for r in pieces:
        if r["first_conv"] != last:
            begun = (at, tuple(sums))
        out[r["part"]] = (at, tuple(sums), begun)
        shift = [pow(b, at, 1 << 64) for b in _BASES]
        if r["last_at"]:
            begun = (at + r["last_at"], tuple((s + f * (r[name] & _MASK)) & _MASK for s, f, name in zip(sums, shift, ("l1", "l2"))))
        last = r["last_conv"]
        sums = [(s + f * (r[name] & _MASK)) & _MASK for s, f, name in zip(sums, shift, ("s1", "s2"))]
        at += r["n"]
    return out


def _keyed(shared):
    """Global sums to the keys of each conversation's own prefixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next(batches, None)
        while head is not None and not head.num_rows:
            head = next(batches, None)
        if head is None:
            return
        at, sums, (start, before) = shared.value[int(_columns(head, "part")[0][0])]
        conv_now = int(_columns(head, "conv_id")[0][0])

        def rest():
            yield head
            yield from batches

        for batch, conv, at, runs in _running(rest(), at, list(sums)):
            fresh = np.concatenate([[conv[0] != conv_now], conv[1:] != conv[:-1]])
            group = np.cumsum(fresh)  # 0: the conversation that came in with the batch
            begins = np.flatnonzero(fresh)
            first = np.concatenate([[start], begins + at])
            out = []
            for k, run in enumerate(runs):
                base = np.concatenate([np.array([before[k]], np.uint64), run[begins]])
                back = np.array([pow(_INVERSES[k], int(s), 1 << 64) for s in first], np.uint64)
                out.append([((edge - base[group]) * back[group]).view(np.int64) for edge in (run[1:], run[:-1])])  # after and before each turn
            pos = np.arange(at, at + len(conv)) - first[group] + 1
            arrays = [conv, pos, out[0][0], out[1][0], out[0][1], out[1][1], _columns(batch, "chars")[0]]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["conv_id", "pos", "k1", "k2", "p1", "p2", "chars"])
            conv_now, start = int(conv[-1]), int(first[-1])
            if len(begins):
                before = tuple(int(r[begins[-1]]) for r in runs)

    return run


def share_openings(own: DataFrame, convs: DataFrame, most: int, group: int) -> DataFrame:
    """Prefixes of the conversations rebuilt on the opening of another one.

    Conversation c gets the first h turns (all, if there are fewer) of conversation ``c - c % group`` in place of its own first h, with h =
    crc32 of c's decimal digits modulo ``most + 1``.  own: :func:`prefixes`; convs: one row per ``conv_id``.
    Returns ``conv_id, depth, k1, k2, p1, p2, chars, is_end``, a row per conversation and depth, the empty prefix (depth 0) included.
    """
    sizes = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    heads = own.where(F.col("pos") <= most).groupBy("conv_id").agg(  # at most ``most`` entries each
        F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "p1", "p2", "chars"))).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    each = staged(
        convs.join(sizes, "conv_id", "left").join(heads, "conv_id", "left")
        .select("conv_id", F.coalesce("n", F.lit(0)).alias("n"), "head", h.alias("h")), "conversations")
    base = each.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"), F.col("head").alias("base_head"))
    from_id = F.col("conv_id") - F.col("conv_id") % F.lit(group)
    k = F.least(F.col("h"), F.coalesce("base_n", F.lit(0))).cast("int")
    plan = each.join(base, from_id == F.col("base_id"), "left").withColumn("k", k)
    own_h = F.least(F.col("h"), F.col("n")).cast("int")

    def key_at(head: str, place: Column, name: str) -> Column:
        return F.when(place > 0, F.element_at(head, place)[name]).otherwise(F.lit(0)).cast("bigint")

    plan = staged(plan.select(
        "conv_id", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        F.when(F.col("k") > 0, F.slice("base_head", F.lit(1), F.col("k"))).alias("lent"),
        *[key_at("base_head", F.col("k"), f"k{i}").alias(f"b{i}") for i in (1, 2)],
        *[key_at("head", own_h, f"k{i}").alias(f"h{i}") for i in (1, 2)]), "plan")
    zero = F.lit(0).cast("bigint")
    root = plan.select("conv_id", zero.alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "chars")], (F.col("length") == 0).alias("is_end"))
    lent = plan.select("conv_id", "length", F.inline("lent")).select(
        "conv_id", F.col("pos").alias("depth"), "k1", "k2", "p1", "p2", "chars", (F.col("pos") == F.col("length")).alias("is_end"))
    tail = own.join(plan.drop("lent"), "conv_id").where(F.col("pos") > F.col("h")).mapInArrow(
        _moved, "conv_id bigint, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, chars bigint, is_end boolean")
    return root.unionByName(lent).unionByName(tail)


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of own turns behind a borrowed opening: the opening's key plus the own turns' share, moved to its new places."""
    for batch in batches:
        conv, pos, h, k, length, chars = _columns(batch, "conv_id", "pos", "h", "k", "length", "chars")
        depth = pos - h + k
        keys = []
        for i in (1, 2):
            back = np.array([pow(_INVERSES[i - 1], d, 1 << 64) for d in range(64)], np.uint64)[h - k]
            opening, own_h = (c.view(np.uint64) for c in _columns(batch, f"b{i}", f"h{i}"))
            keys.append([(opening + (c.view(np.uint64) - own_h) * back).view(np.int64) for c in _columns(batch, f"k{i}", f"p{i}")])
        arrays = [conv, depth, keys[0][0], keys[1][0], keys[0][1], keys[1][1], chars]
        yield pa.RecordBatch.from_arrays([*[pa.array(a, pa.int64()) for a in arrays], pa.array(depth == length)],
                                         ["conv_id", "depth", "k1", "k2", "p1", "p2", "chars", "is_end"])


# --- 2. nodes ------------------------------------------------------------------------------------

def nodes(rows: DataFrame) -> DataFrame:
    """Equal prefixes as one row: ``node`` (smallest member and depth), ``parent`` (null: the root), ``n_convs``, ``chars`` and the keys."""
    one = staged(rows.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"),
        F.first("p1").alias("p1"), F.first("p2").alias("p2")), "nodes")
    up = one.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                    F.struct("conv_id", "depth").cast(NODE).alias("parent"))
    return one.join(up, ["depth", "p1", "p2"], "left").select(
        F.struct("conv_id", "depth").cast(NODE).alias("node"), "parent", "n_convs", "chars", *_KEY)


def ends_digest(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``node, ends_sha256`` for nodes at which a conversation ends.  A digest is sequential: each node's ids stream through one task in order."""
    at = rows.where("is_end").select(*_KEY, F.col("conv_id").alias("id")).join(named.select(*_KEY, "node"), _KEY)
    dealt = at.select("node.conv_id", "node.depth", "id").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "id")
    return dealt.mapInArrow(_digest, "conv_id bigint, depth bigint, ends_sha256 string").select(
        F.struct("conv_id", "depth").cast(NODE).alias("node"), "ends_sha256")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "depth", "ends_sha256"]

    def batch_of(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names)

    now, digest = None, None
    for batch in batches:
        conv, depth, ids = _columns(batch, "conv_id", "depth", "id")
        if not len(ids):
            continue
        cuts = np.flatnonzero((conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) + 1
        done = []
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            node = (int(conv[a]), int(depth[a]))
            listed = ",".join(map(str, ids[a:b].tolist())).encode()
            if node == now:
                digest.update(b"," + listed)
            else:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(listed)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([(*now, digest.hexdigest())])


# --- 3. contraction ------------------------------------------------------------------------------

def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """``node`` and, for each of ``values``, its sum over the node's subtree.

    tree: ``node, parent`` (null at roots) and the values, one row per node; a forest without cycles.
    """
    edges = [f"up_{v}" for v in values]  # what a node brings to its parent beside its own total: chains that were taken out between them
    live = staged(tree.select("node", "parent", *values, *[F.lit(0).cast("bigint").alias(e) for e in edges]), "live")
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while not live.isEmpty():
        kids = live.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("kids"), F.min("node").alias("to"), *[F.sum(e).alias(f"step_{e}") for e in edges])
        seen = staged(live.join(kids, "node", "left"), "seen")
        unary = seen.where("kids = 1").select(
            "node", "parent", "to", *edges, *[(F.col(v) + F.col(f"step_{e}")).alias(v) for v, e in zip(values, edges)])
        left = seen.where("kids is null or kids > 1").select("node", "parent", "kids", *values, *edges)
        chain = _chain_sums(unary, values, edges)
        if chain is not None:
            # The end of a chain hangs on the parent of its top from now on; what stood between comes with it.
            inner = unary.select(F.col("node").alias("parent"), F.lit(True).alias("inner"))
            tops = chain.join(inner, "parent", "left").where("inner is null").select(
                F.col("to").alias("node"), F.col("parent").alias("above"), *[(F.col(v) + F.col(e)).alias(f"more_{v}") for v, e in zip(values, edges)])
            left = left.join(tops, "node", "left").select(
                "node", F.when(F.col(f"more_{values[0]}").isNull(), F.col("parent")).otherwise(F.col("above")).alias("parent"), "kids", *values,
                *[F.coalesce(f"more_{v}", e).alias(e) for v, e in zip(values, edges)])
            left = staged(left, "left")
        leaves = left.where("kids is null")
        rounds.append((leaves.select("node", *values), chain))
        given = leaves.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(v) + F.col(e)).alias(f"got_{v}") for v, e in zip(values, edges)])
        live = staged(left.where("kids is not null").join(given, "node", "left").select(
            "node", "parent", *[(F.col(v) + F.coalesce(f"got_{v}", F.lit(0))).alias(v) for v in values], *edges), "live")
    totals = None
    for raked, chain in reversed(rounds):
        totals = raked if totals is None else totals.unionByName(raked)
        if chain is not None:
            below = totals.select(F.col("node").alias("to"), *[F.col(v).alias(f"below_{v}") for v in values])
            regained = staged(chain.join(below, "to").select("node", *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values]), "regained")
            totals = totals.unionByName(regained)
    return tree.select("node", *values).limit(0) if totals is None else totals


def _chain_sums(unary: DataFrame, values: list[str], edges: list[str]) -> DataFrame | None:
    """Unary nodes with ``to``, the first node below that is not unary, and the sums from the node down to there; None if there are none.

    Pointer doubling: a round adds what the node pointed to has gathered and points where it points.
    """
    at = staged(unary, "chain")
    if at.isEmpty():
        return None
    while True:
        ahead = at.select(F.col("node").alias("to"), F.col("to").alias("next"), *[F.col(v).alias(f"next_{v}") for v in values])
        jumped = staged(at.join(ahead, "to", "left").select(
            "node", "parent", *edges, F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"),
            *[(F.col(v) + F.coalesce(f"next_{v}", F.lit(0))).alias(v) for v in values]), "chain")
        at = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return at


def trie(turns: DataFrame, most: int = 5, group: int = 100) -> DataFrame:
    """The prefix trie of the conversations rebuilt by :func:`share_openings`, one row per node.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    convs = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    if convs.isEmpty():
        return _bare_root(turns)
    own = staged(prefixes(turns), "prefixes")
    rows = staged(share_openings(own, convs, most, group), "rebuilt")
    named = nodes(rows)
    children = named.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    named = staged(named.join(children, "node", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "n_leaves": F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    }), "named")
    values = ["n_leaves", "saved_tokens"]
    sums = subtree_sums(named.select("node", "parent", *values), values)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        named.drop(*values).join(sums, "node").join(ends_digest(rows, named), "node", "left")
        .select(F.col("node.conv_id").alias("conv_id"), F.col("node.depth").alias("depth"), F.col("parent.conv_id").alias("parent_conv_id"),
                "n_convs", "n_children", *values, F.coalesce("ends_sha256", none).alias("ends_sha256")))


def _bare_root(turns: DataFrame) -> DataFrame:
    """The trie of no conversation: a root without members."""
    values = {"conv_id": None, "depth": 0, "parent_conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 1, "saved_tokens": 0}
    return turns.sparkSession.range(1).select(
        *[F.lit(v).cast("bigint").alias(c) for c, v in values.items()], F.lit(hashlib.sha256(b"").hexdigest()).alias("ends_sha256"))
