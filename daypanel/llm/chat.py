r"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it are context, and its reply alone is trainable.
:func:`format_conversations` writes a conversation once, in one segment per turn; an example is a prefix of it and three offsets:
where its reply begins and ends (the loss mask) and where the example ends.  :func:`expanded` writes every example out, as a
trainer gets it.  That squares the size of a long conversation, which is the method's output; :func:`example_texts` does it for chosen
examples alone.

Template (a turn's markers depend on its role; any other role is written between role markers):
``[INST] user [/INST]``, ``<<SYS>> system <</SYS>>``, ``<s>assistant</s>``, ``[ROLE]name[/ROLE] text [/TEXT]``.
Inside texts and role names a backslash is put after the first character of every marker, and after those
that already stand there, which :func:`unescape` takes back exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.llm.frames import staged
from daypanel.session import durable

_TAILS = r"/?INST\]|/?ROLE\]|/TEXT\]|/?s>|</?SYS>>"
_PLAIN = rf"([\[<])(\\*)(?={_TAILS})"
_ESCAPED = rf"([\[<])(\\*)\\(?={_TAILS})"
# No closing marker stands inside a text or role name, so the first one ends the turn.
_SEGMENT = r"(?s)\[INST\] .*? \[/INST\]|<<SYS>> .*? <</SYS>>|<s>.*?</s>|\[ROLE\].*?\[/ROLE\] .*? \[/TEXT\]"
_WRAP = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>"), "assistant": ("<s>", "</s>")}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per turn: ``conv_id, position, role, segment, start, end, loss_start, loss_end``.

    The segments of a conversation in order of ``position`` are its formatted text; ``start`` and ``end`` say where a
    segment lies in it (code points, end exclusive).  Assistant turns also carry their loss span, and are the examples:
    example = formatted text up to ``end``, trainable between ``loss_start`` and ``loss_end``.

    Turns are ordered by turn number (null first), then role, then text; repeated rows are separate turns.  A null text
    or role counts as empty, a null conversation id as an id of its own.  Columns of other names are not read.

    Runs a job.  Turns are dealt by range of (conversation, turn), so a conversation of any length is spread over tasks;
    what a task needs to know of those before it is one row per partition.
    """
    names = (F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
             F.coalesce(F.col(text), F.lit("")).alias("text"))
    safe, who = escape(F.col("text")), escape(F.col("role"))
    head = F.concat(F.lit("[ROLE]"), who, F.lit("[/ROLE] "))
    tail = F.lit(" [/TEXT]")
    for name, (before, after) in _WRAP.items():
        head = F.when(F.col("role") == name, F.lit(before)).otherwise(head)
        tail = F.when(F.col("role") == name, F.lit(after)).otherwise(tail)
    order = ["conv_id", "turn", "role", "segment"]
    segments = (
        turns.select(*names)
        .select("conv_id", "turn", "role", F.concat(head, safe, tail).alias("segment"),
                F.length(head).cast("bigint").alias("before"), F.length(safe).cast("bigint").alias("said"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    fixed = durable(segments)
    placed = fixed.mapInArrow(_place, "part int, conv_id bigint, position bigint, role string, segment string, start bigint, "
                                      "size bigint, before bigint, said bigint, opening boolean")
    # What a partition's last conversation has used up when the next partition goes on with it.
    used = placed.groupBy("part").agg(
        F.max_by(F.struct("conv_id"), F.struct(~F.col("opening"), F.col("conv_id"), F.col("position"))).alias("last"),
        F.max_by(F.struct((F.col("position") + 1).alias("turns"), (F.col("start") + F.col("size")).alias("chars")),
                 F.struct(~F.col("opening"), F.col("conv_id"), F.col("position"))).alias("sums"),
        F.min_by(F.struct("conv_id"), F.struct(~F.col("opening"))).alias("first"))
    by_part = Window.orderBy("part")
    run = used.withColumn("begins", (F.lag("last").over(by_part).isNull() | (F.lag("last").over(by_part) != F.col("last"))
                                     | (F.col("first") != F.col("last"))).cast("int"))
    run = run.withColumn("run", F.sum("begins").over(by_part))
    within = Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    run = run.withColumns({"turns": F.sum("sums.turns").over(within), "chars": F.sum("sums.chars").over(within)})
    carry = run.select("part", *[F.when(F.lag("last").over(by_part) == F.col("first"), F.lag(c).over(by_part)).alias(f"{c}_before")
                                 for c in ("turns", "chars")])
    opening = F.col("opening")
    joined = placed.join(F.broadcast(durable(carry)), "part")  # one row per partition
    start = F.col("start") + F.when(opening, F.coalesce("chars_before", F.lit(0))).otherwise(0)
    position = F.col("position") + F.when(opening, F.coalesce("turns_before", F.lit(0))).otherwise(0)
    reply = F.col("role") == "assistant"
    return joined.select(
        "conv_id", position.alias("position"), "role", "segment", start.alias("start"), (start + F.col("size")).alias("end"),
        F.when(reply, start + F.col("before")).alias("loss_start"),
        F.when(reply, start + F.col("before") + F.col("said")).alias("loss_end"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id, target, chars, loss_start, loss_end`` (offsets into the formatted text)."""
    return formatted.where(F.col("loss_start").isNotNull()).select(
        "conv_id", F.col("position").alias("target"), F.col("end").alias("chars"), "loss_start", "loss_end")


def example_texts(formatted: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the ``wanted`` rows of :func:`examples`, written out: ``text`` is added.

    The output holds every context in full, so its size is what the caller asks for.
    """
    w = wanted.withColumn("wanted_conv", F.col("conv_id")).drop("conv_id")
    pieces = w.join(formatted.select("conv_id", "position", "segment"),
                    w["wanted_conv"].eqNullSafe(formatted["conv_id"]) & (F.col("position") <= F.col("target")))
    return pieces.groupBy("conv_id", "target", "chars", "loss_start", "loss_end").agg(_joined().alias("text"))


def expanded(formatted: DataFrame) -> DataFrame:
    """Every example written out: ``conv_id, target, first, text, loss_start, loss_end``, one row per assistant turn.

    ``text`` is the whole context and the reply, offsets count from its begin, and ``first`` is 0.  What follows a conversation's last reply is
    in no example; it makes a row of its own, with a null ``target`` and from turn ``first`` on.  Runs a job.  The texts are put together per
    example, so those of a long conversation are spread over tasks.
    """
    kept = staged(formatted, "formatted")
    nothing = F.lit(None).cast("bigint")
    reply = F.when(F.col("loss_start").isNotNull(), F.col("position"))
    ends = kept.groupBy("conv_id").agg(F.max(reply).alias("replied"), F.max("position").alias("last"))
    rest = ends.where(F.col("replied").isNull() | (F.col("replied") < F.col("last"))).select(
        F.col("conv_id").alias("conv"), nothing.alias("target"), F.coalesce(F.col("replied") + 1, F.lit(0)).alias("first"), "last",
        nothing.alias("loss_start"), nothing.alias("loss_end"))
    wanted = examples(kept).select(F.col("conv_id").alias("conv"), "target", F.lit(0).cast("bigint").alias("first"), F.col("target").alias("last"),
                                   "loss_start", "loss_end").unionByName(rest)
    pieces = wanted.join(kept.select("conv_id", "position", "segment"), F.col("conv").eqNullSafe(F.col("conv_id"))
                         & F.col("position").between(F.col("first"), F.col("last")))
    return pieces.groupBy("conv_id", "target", "first", "loss_start", "loss_end").agg(_joined().alias("text")).select(
        "conv_id", "target", "first", "text", "loss_start", "loss_end")


def read_back_examples(examples: DataFrame) -> DataFrame:
    """The columns of :func:`read_back`, from the texts of :func:`expanded`: every text is taken apart at its markers.

    A turn is taken from the first example that holds it: of each those after the reply before its own.
    """
    segments = F.regexp_extract_all("text", F.lit(_SEGMENT), F.lit(0))
    parsed = examples.withColumn("segments", segments)
    n = F.size("segments")
    # From the end, without the example's own reply: how far back the reply before it is.
    back = F.array_position(F.transform(F.reverse(F.slice("segments", F.lit(1), n - 1)), lambda s: s.startswith("<s>")), True).cast("int")
    size = F.when(F.col("target").isNull() | (back == 0), n).otherwise(back)
    parsed = parsed.withColumn("size", size)
    own = F.slice("segments", n - F.col("size") + 1, F.col("size"))
    masked = F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    turns = parsed.select(
        "conv_id", "target", "first", "size", unescape(masked).alias("masked"), F.length("text").cast("bigint").alias("chars"),
        own.alias("own")).select("*", F.posexplode_outer("own").alias("k", "segment")).drop("own")
    position = F.coalesce(F.col("target") + 1 - F.col("size"), F.col("first")) + F.col("k")
    at_reply = position == F.col("target")
    return turns.select("conv_id", position.alias("position"), *_turn(F.col("segment")), F.when(at_reply, F.col("masked")).alias("trainable"),
                        F.length("segment").cast("bigint").alias("n_chars"), F.when(at_reply, F.col("chars")).alias("example_chars"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, position, role, text, trainable, n_chars``: the turns as the template's markers tell them.

    ``trainable`` is the text that the loss mask covers, unescaped; null outside assistant turns.
    """
    seg = F.col("segment")
    masked = F.substring(seg, (F.col("loss_start") - F.col("start") + 1).cast("int"),
                         (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return formatted.select("conv_id", "position", *_turn(seg),
                            F.when(F.col("loss_start").isNotNull(), unescape(masked)).alias("trainable"),
                            F.length(seg).cast("bigint").alias("n_chars"),
                            F.when(F.col("loss_start").isNotNull(), F.col("end")).alias("example_chars"))


def _turn(segment: Column) -> tuple[Column, Column]:
    """Role and text of one segment."""
    other = r"(?s)^\[ROLE\](.*?)\[/ROLE\] (.*) \[/TEXT\]$"
    role, text = F.regexp_extract(segment, other, 1), F.regexp_extract(segment, other, 2)
    for name, (before, after) in _WRAP.items():
        mine = segment.startswith(before)
        role = F.when(mine, F.lit(name)).otherwise(role)
        text = F.when(mine, F.substring(segment, F.lit(len(before) + 1), F.length(segment) - len(before) - len(after))).otherwise(text)
    return unescape(role).alias("role"), unescape(text).alias("text")


def _joined() -> Column:
    """The segments of a group in order, as one text."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "segment"))), lambda x: x["segment"]), "")


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of :func:`read_back` or :func:`read_back_examples`: counts and SHA-256 digests.

    A digest is sequential by nature, so a conversation's turns stream through one task in order, one batch at a time.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(_digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                       "loss_sha256 string, formatted_chars bigint, n_examples bigint, example_chars bigint")


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running turn and character counts inside a sorted partition."""
    from pyspark import TaskContext

    part, current, position, start, opening = TaskContext.get().partitionId(), (), 0, 0, True
    for batch in batches:
        convs, sizes = batch.column("conv_id").to_pylist(), [len(s) for s in batch.column("segment").to_pylist()]
        positions, starts, openings = [], [], []
        for conv, size in zip(convs, sizes, strict=True):
            if (conv,) != current:
                opening = current == ()
                current, position, start = (conv,), 0, 0
            positions.append(position)
            starts.append(start)
            openings.append(opening)
            position += 1
            start += size
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(convs), pa.int32()), pa.array(convs, pa.int64()), pa.array(positions, pa.int64()),
             batch.column("role"), batch.column("segment"), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
             batch.column("before"), batch.column("said"), pa.array(openings, pa.bool_())],
            ["part", "conv_id", "position", "role", "segment", "start", "size", "before", "said", "opening"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    current: list | None = None

    def closed(rows: list) -> pa.RecordBatch:
        flat = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), *r[5:]] for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in flat], t) for k, t in enumerate(types)], names)

    for batch in batches:
        done = []
        for conv, role, text, reply, n, chars in zip(*(batch.column(c).to_pylist() for c in
                                                       ("conv_id", "role", "text", "trainable", "n_chars", "example_chars")),
                                                     strict=True):
            if current is None or current[0] != conv:
                if current is not None:
                    done.append(current)
                current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            current[1] += 1
            current[2].update(f"{role}\n{text}\n".encode())
            current[5] += n
            if reply is not None:
                current[3] += len(reply)
                current[4].update(reply.encode())
                current[6] += 1
                current[7] += chars
        if done:
            yield closed(done)
    if current is not None:
        yield closed([current])
