r"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

*Protected entities* are the addresses, numbers and so on that patterns find (base kinds).  A term that stands near an entity and hardly anywhere else
gives it away even where the entity itself was removed.  How strongly, the corpus says: with N documents, of which n(e) hold entity e, d(t)
hold term t and c(e, t) have t within ``REACH`` words of e,

    PMI(e; t) = log2(N c(e, t) / (n(e) d(t))),   IC(e) = log2(N / n(e)),

and t discloses e if PMI(e; t) >= ``DISCLOSED`` * IC(e), given c(e, t) >= ``SUPPORT`` documents as evidence.  PMI = IC means that every document with
t has e beside it.  A disclosing term is generalised to the first half of its letters if that form, over all words that share it, no
longer discloses e, and removed otherwise; in both cases wherever in the corpus it stands.

How it runs.

1. Patterns are tried on every text; texts are keyed by SHA-256, so copies are one row with a count from there on.
2. Entity and term pairs are counted from the words around the mentions: at most ``2 * REACH`` a mention, however long the text is.
3. Documents per term and per general form are counted over the whole corpus.  A bitmap of ``BITS`` bits, whose size does not depend on
   the data, keeps most other words out of the shuffle; the join with the terms after it decides.
4. The places of disclosing terms are found the same way, and all spans are joined back to the documents by key, where adaptive
   execution splits the key of a hot group of copies.

Places are sums of lengths: a text is split at its matches, and the lengths of pieces and matches are added up in blocks, so the time is linear in
the number of matches.  The patterns try a long run of characters once, from its start.

Defined cases.  A null text is empty and has no findings.  Repeated rows and ids each get the findings of their text.  Spans are code points, end
exclusive; kinds may overlap each other.  An empty table gives no rows.  Columns of any name are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm.frames import bitmap, marked, staged

REACH = 8
SUPPORT = 3
DISCLOSED = 0.9
BITS = 1 << 20
_BLOCK = 256

# Words are runs of ASCII letters, digits and all characters beyond ASCII.  The others one by one: the regex engine looks such a class up in a table.
_OTHERS = "".join(f"\\x{c:02x}" for c in range(0x80) if not chr(c).isalnum())
_IN, _OUT = f"[^{_OTHERS}]", f"[{_OTHERS}]"
_AROUND = f"^(?:{_OUT}*+{_IN}++){{0,{REACH}}}"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """A base kind: its pattern, a text that all matches hold, and what a match must fulfil besides."""

    name: str
    pattern: str
    hint: str
    digits: tuple[int, int] | None = None
    luhn: bool = False
    also: str | None = None


#: Fixed by the contract, in the order in which equal starts are listed.  A run that fails from its start fails from every place in it, so
#: look-behinds and possessive quantifiers change no match; an address may also begin where the one before it ended (``\G``).
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", also=rf"^{_PART}(?:\.{_PART}){{3}}$"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", (12, 19), luhn=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", (9, 15)),
)
GENERAL, REMOVED = "general", "removed"
ORDER = (*[k.name for k in KINDS], GENERAL, REMOVED)
SPANS = "array<struct<start:bigint,ord:int,kind:string,end:bigint>>"


def scan(docs: DataFrame, keep: Sequence[str] | None = None, text: str = "text", support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """The ``keep`` columns (all, if None) with ``findings``: spans of ``start, ord, kind, end`` by start, then the order of kinds.

    A column named ``findings`` is replaced.
    """
    base = _entities(docs, text)
    terms = disclosing_terms(docs, base, text, support, disclosed)
    found = base.select("key", "spans").unionByName(_term_spans(docs, terms, text))
    found = found.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("findings"))  # two lists at most
    columns = [c for c in (docs.columns if keep is None else keep) if c != "findings"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), _key(text).alias("key"))
    joined = rows.join(found, "key", "left")
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], F.coalesce("findings", F.array().cast(SPANS)).alias("findings"))


def sanitised(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with findings taken out of the text: base kinds as ``<kind>``, disclosing terms generalised or as ``<removed>``.

    Overlapping spans are one, named after the first.  ``findings`` keeps the spans in the former text.
    """
    found = scan(docs, text=text, **options)
    def grown(a: Column, x: Column) -> Column:
        last = F.element_at(a, -1)
        one = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], x["end"]).alias("end"))
        fresh = F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
        return F.when((F.size(a) > 0) & (x["start"] < last["end"]), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(one))).otherwise(F.array_append(a, fresh))

    merged = F.aggregate("findings", F.array().cast("array<struct<start:bigint,kind:string,end:bigint>>"), grown)
    # Four bytes a character, so that a piece is cut out without counting from the start of the text.
    wide = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-32")

    def cut(start: Column, end: Column) -> Column:
        return F.decode(F.substring("__wide", (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")), "UTF-32")

    def said(i: Column) -> Column:
        x = F.element_at("__cuts", i + 1)
        before = F.when(i > 0, F.element_at("__cuts", F.greatest(i, F.lit(1)))["end"]).otherwise(F.lit(0))
        word = cut(x["start"], x["end"])
        put = F.when(x["kind"] == GENERAL, _general(word)).otherwise(F.concat(F.lit("<"), x["kind"], F.lit(">")))
        return F.concat(cut(before, x["start"]), put)

    places = F.when(F.size("__cuts") > 0, F.sequence(F.lit(0), F.size("__cuts") - 1)).otherwise(F.array().cast("array<int>"))
    rest = cut(F.element_at("__cuts", -1)["end"], F.octet_length("__wide") / 4)
    clean = F.when(F.size("__cuts") > 0, F.concat(F.array_join(F.transform(places, said), ""), rest)).otherwise(F.col(text))
    return found.withColumns({"__cuts": merged, "__wide": wide}).withColumn(text, clean).drop("__cuts", "__wide")


# --- 1. entities ---------------------------------------------------------------------------------

def _key(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _entities(docs: DataFrame, text: str) -> DataFrame:
    """``key, copies, spans, mentions`` of every text in which a pattern matched; a mention is an entity with the words around it."""
    at = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    at = at.withColumns({f"m_{k.name}": F.when(F.contains("text", F.lit(k.hint)), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)))
                         for k in KINDS})
    at = at.where(" or ".join(f"size(m_{k.name}) > 0" for k in KINDS))
    at = at.withColumns({f"g_{k.name}": F.when(F.size(f"m_{k.name}") > 0, F.split("text", k.pattern, -1)) for k in KINDS})
    at = at.withColumns({f"s_{k.name}": _before(F.zip_with(
        F.slice(f"g_{k.name}", F.lit(1), F.size(f"m_{k.name}")), f"m_{k.name}", lambda g, m: (F.length(g) + F.length(m)).cast("bigint")))
        for k in KINDS})
    at = at.withColumns({f"f_{k.name}": _found(k, n) for n, k in enumerate(KINDS)})
    # No filter on the hits: it would be pushed below the columns they are made of, which would then be computed for each match.
    none = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint,entity:string,before:string,after:string>>")
    at = at.select("text", F.concat(*[F.coalesce(f"f_{k.name}", none) for k in KINDS]).alias("hits"))
    spans = F.array_sort(F.transform("hits", lambda x: F.struct(x["start"].alias("start"), x["ord"].alias("ord"), x["kind"].alias("kind"), x["end"].alias("end"))))
    mentions = F.transform("hits", lambda x: F.struct(x["entity"].alias("entity"), _context(x["before"], x["after"]).alias("terms")))
    each = at.select(_key("text").alias("key"), spans.alias("spans"), mentions.alias("mentions"))
    once = each.groupBy("key").agg(F.count("*").alias("copies"), F.first("spans").alias("spans"), F.first("mentions").alias("mentions"))
    return staged(once, "entities")


def _found(kind: Kind, order: int) -> Column:
    """Matches of a kind that hold, with place, entity and the text between them and their neighbours."""
    gaps, starts = F.col(f"g_{kind.name}"), F.col(f"s_{kind.name}")

    def hit(value: Column, i: Column) -> Column:
        start = F.get(starts, i) + F.length(F.get(gaps, i))
        plain = F.lower(value) if kind.digits is None else _digits(value)
        return F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(kind.name).alias("kind"), (start + F.length(value)).alias("end"),
                        F.concat(F.lit(f"{kind.name}:"), plain).alias("entity"), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"),
                        value.alias("value"))

    def holds(x: Column) -> Column:
        rules = [F.lit(True)]
        if kind.digits:
            rules.append(F.length(_digits(x["value"])).between(*kind.digits))
        if kind.luhn:
            rules.append(F.call_function("luhn_check", _digits(x["value"])))
        if kind.also:
            rules.append(x["value"].rlike(kind.also))
        out = rules[0]
        for r in rules[1:]:
            out = out & r
        return out

    found = F.filter(F.transform(f"m_{kind.name}", hit), holds)
    return F.transform(found, lambda x: x.dropFields("value"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _before(steps: Column) -> Column:
    """For each step the sum of those before it; in blocks, since appending copies what an array holds already."""
    def fold(items: Column, value, out) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("at"))
        return F.aggregate(items, zero, lambda a, x: F.struct((a["sum"] + value(x)).alias("sum"), F.array_append(a["at"], a["sum"]).alias("at")), out)

    def blocks(steps: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
                           lambda b: fold(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)), lambda x: x, lambda a: a))

    def spread(parts: Column) -> Column:
        return F.flatten(F.zip_with(parts, fold(parts, lambda x: x["sum"], lambda a: a["at"]), lambda p, base: F.transform(p["at"], lambda v: v + base)))

    return F.when(F.size(steps) > 0, _let(_let(steps, blocks), spread))


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once, however often and in whatever lambda it stands there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _context(before: Column, after: Column) -> Column:
    """Lower-cased words within reach on both sides."""
    left = F.reverse(F.regexp_extract(F.reverse(before), _AROUND, 0))
    near = F.concat(left, F.lit(" "), F.regexp_extract(after, _AROUND, 0))
    return F.array_distinct(_words(near))


def _words(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, f"{_OUT}+", -1), lambda w: w != ""), F.lower)


def _general(word: Column) -> Column:
    """The first half of a word's characters; a star stands for the rest."""
    return F.concat(F.substring(word, F.lit(1), F.floor((F.length(word) + 1) / 2).cast("int")), F.lit("*"))


def _hit(word: Column) -> Column:
    return marked(F.col("bits"), word, BITS)


# --- 2. and 3. disclosure ------------------------------------------------------------------------

def disclosing_terms(docs: DataFrame, entities: DataFrame, text: str = "text", support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """``term, kind`` (general or removed) of all terms that disclose an entity, see the head of this module."""
    met = entities.select("key", "copies", F.inline("mentions")).select("key", "copies", "entity", F.explode("terms").alias("term"))
    # A term counts as itself and as its general form, which no word equals.
    met = met.select("key", "copies", "entity", F.explode(F.array("term", _general(F.col("term")))).alias("form")).distinct()
    pairs = staged(met.groupBy("entity", "form").agg(F.sum("copies").alias("both")).where(F.col("both") >= support), "pairs")
    holders = entities.select("key", "copies", F.inline("mentions")).select("key", "copies", "entity").distinct().groupBy("entity").agg(
        F.sum("copies").alias("holders"))
    bits = bitmap(pairs.select("form"), BITS)
    forms = F.array_distinct(_words(F.col("text")))
    every = F.concat(forms, F.array_distinct(F.transform(forms, _general)))
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The outer forms of explode and inline, since the others make Spark compute their arrays once more, in a filter that leaves out empty ones.
    seen = texts.select(every.alias("forms")).withColumn("bits", bits).select(F.explode_outer(F.filter("forms", _hit)).alias("form"))
    spread = seen.where(F.col("form").isNotNull()).groupBy("form").agg(F.count("*").alias("spread"))
    n_docs = docs.agg(F.count("*").alias("n")).scalar()
    judged = pairs.join(spread, "form").join(holders, "entity").withColumn("all", n_docs)
    ic = F.log2(F.col("all") / F.col("holders"))
    pmi = F.log2(F.col("all") * F.col("both") / (F.col("holders") * F.col("spread")))
    disclosing = staged(judged.where((F.col("holders") < F.col("all")) & (pmi >= ic * disclosed)).select("entity", "form"), "disclosing")
    star = F.col("form").endswith("*")
    wide = disclosing.where(star).select("entity", F.col("form").alias("wide"), F.lit(True).alias("still"))
    terms = disclosing.where(~star).withColumn("wide", _general(F.col("form"))).join(wide, ["entity", "wide"], "left")
    kind = F.when(F.max(F.coalesce("still", F.lit(False))), F.lit(REMOVED)).otherwise(F.lit(GENERAL))
    return staged(terms.groupBy(F.col("form").alias("term")).agg(kind.alias("kind")), "terms")


# --- 4. places -----------------------------------------------------------------------------------

def _term_spans(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """``key, spans``: the places of disclosing terms in every text that holds one."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("bits", bitmap(terms.select("term"), BITS))
    texts = texts.where(F.exists(F.array_distinct(_words(F.col("text"))), _hit))
    at = texts.withColumns({"said": F.regexp_extract_all("text", F.lit(f"{_IN}+"), F.lit(0)), "gaps": F.split("text", f"{_IN}+", -1)})
    at = at.withColumn("gaps", F.transform("gaps", F.length))
    at = at.withColumn("starts", _before(F.zip_with(F.slice("gaps", F.lit(1), F.size("said")), "said", lambda g, w: (g + F.length(w)).cast("bigint"))))

    def placed(word: Column, i: Column) -> Column:
        start = F.get(F.col("starts"), i) + F.get(F.col("gaps"), i)
        return F.struct(F.lower(word).alias("term"), start.alias("start"), (start + F.length(word)).alias("end"))

    hits = at.withColumn("hits", F.filter(F.transform("said", placed), lambda x: _hit(x["term"])))
    each = hits.select(_key("text").alias("key"), F.inline_outer("hits")).where(F.col("term").isNotNull()).distinct()
    order = F.when(F.col("kind") == GENERAL, F.lit(ORDER.index(GENERAL))).otherwise(F.lit(ORDER.index(REMOVED)))
    return each.join(terms, "term").groupBy("key").agg(F.collect_list(F.struct("start", order.alias("ord"), "kind", "end")).cast(SPANS).alias("spans"))
