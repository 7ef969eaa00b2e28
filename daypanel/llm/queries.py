"""Registered queries of the operators of this folder, and SQL counterparts where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daypanel.llm import (
    backoff, blob_ledger, buckets, chat, collocations, golay, latent, line_dedup, notices, prefix_trie, rule_ledger, sanitise,
    windows,
)
from daypanel.llm.frames import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, counts=("n_lines", "n_dropped"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assistant turn as an example of its own, written out; what the examples say, read back from the template, one row per conversation."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.read_back_examples(chat.expanded(chat.format_conversations(turns))))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class over shared passages of fifty words and more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return windows.passage_classes(docs, windows.repeated_passages(docs))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every document, through the ledger of its content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = blob_ledger.findings(docs, blob_ledger.scan(docs))
    base = [r.name for r in blob_ledger.BASE_RULES]
    mine = F.filter("findings", lambda x: x["kind"].isin(base))
    return found.select("doc_id", *_counts(mine, base), F.sha2(_listed(mine), 256).alias("base_sha256"), _listed(F.col("findings")).alias("spans"))


def _counts(findings: Column, kinds: list[str]) -> list[Column]:
    def count(kind: str) -> Column:
        return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [count(kind) for kind in kinds]


def _listed(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it leaks."""
    return latent.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's Stupid Backoff score under the counts of all documents."""
    return backoff.score(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and component."""
    found = golay.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's row of the rule ledger under the base and the production policy."""
    rows = rule_ledger.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rule_ledger.fails(rule_ledger.BASE).alias("base_failed"), (~rule_ledger.fails(rule_ledger.PRODUCTION)).alias("kept"),
        "fail_bits")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and notices."""
    return notices.scan(table(spark, sf_dir, "documents")).drop("hits")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bucket and batch."""
    return buckets.pack(table(spark, sf_dir, "documents"))


def op11_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document and the terms that give it away."""
    found = sanitise.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = [k.name for k in sanitise.KINDS]
    mine = F.filter("findings", lambda x: x["kind"].isin(base))
    return found.select("doc_id", *_counts(mine, base), F.sha2(_listed(mine), 256).alias("base_sha256"), _listed(F.col("findings")).alias("spans"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, with its subtree's totals."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of the repository's top folder."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_chat_format, op3_substring_dedup, op4_secret_scan, op5_decontamination, op6_lm_scoring, op7_simhash,
    op8_quality_rules, op9_license_scan, op10_packing, op11_sanitise, op12_prefix_trie, op13_collocations, pipeline,
)}

ORACLES: dict[str, str] = {
    "op1_line_dedup": """
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents),
        pages AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
        boilerplate AS (
            SELECT l.source, trim(l.line) AS said
            FROM lines l JOIN pages p ON l.source = p.source
            WHERE trim(l.line) <> '' AND p.pages >= 20
            GROUP BY l.source, trim(l.line), p.pages
            HAVING count(DISTINCT l.doc_id) >= 2 AND count(DISTINCT l.doc_id) > 0.1 * p.pages),
        judged AS (
            SELECT l.*, b.said IS NOT NULL AS gone
            FROM lines l LEFT JOIN boilerplate b ON l.source = b.source AND trim(l.line) = b.said)
        SELECT d.doc_id, d.source,
               CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(j.line, chr(10) ORDER BY j.pos) FILTER (WHERE NOT j.gone), '') END AS text,
               count(j.pos) AS n_lines, count(*) FILTER (WHERE j.gone) AS n_dropped
        FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id
        GROUP BY d.doc_id, d.source, d.text
    """,
    "op12_prefix_trie": """
        WITH own AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'said': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS w
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (
            SELECT conv_id, w, xor(list_reduce(
                list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h
            FROM own),
        rebuilt AS (
            SELECT a.conv_id, CASE WHEN b.w IS NULL THEN a.w[a.h + 1:] ELSE list_concat(b.w[1:a.h], a.w[a.h + 1:]) END AS w
            FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
        depths AS (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS depth FROM rebuilt),
        nodes AS (
            SELECT w[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(w) = depth) AS ends
            FROM depths GROUP BY w[1:depth], depth),
        children AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        valued AS (
            SELECT n.*, coalesce(c.n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.p[depth].said) END AS mine
            FROM nodes n LEFT JOIN children c ON c.p = n.p),
        above AS (SELECT p, mine, n_children, unnest(range(0, depth + 1)) AS d FROM valued),
        sums AS (
            SELECT p[1:d] AS p, sum(mine)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM above GROUP BY 1)
        SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens,
               sha256(coalesce(v.ends, '')) AS ends_sha256
        FROM valued v JOIN sums s ON s.p = v.p LEFT JOIN nodes u ON v.depth > 0 AND u.p = v.p[1:v.depth - 1]
    """,
    "op13_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        said AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM said GROUP BY lang),
        phrases AS (
            SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
            FROM said, range(1, 6) AS lengths(m) WHERE len(w) >= m),
        counts AS (SELECT lang, m, phrase, count(*) AS a FROM phrases GROUP BY ALL HAVING count(*) >= 100),
        candidates AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
        cuts AS (
            SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
            FROM candidates, range(1, 5) AS places(k) WHERE k < m),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, f.a AS l, g.a AS r, s.n, (1000::HUGEINT * c.a * s.n // (f.a::HUGEINT * g.a))::BIGINT AS score
            FROM cuts c JOIN counts f ON f.lang = c.lang AND f.phrase = c.first JOIN counts g ON g.lang = c.lang AND g.phrase = c.rest
            JOIN sizes s ON s.lang = c.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS inside_a
            FROM candidates, range(2, 5) AS sizes(j), range(1, 5) AS places(i) WHERE j < m AND i + j - 1 <= m GROUP BY 1, 2),
        kept AS (SELECT b.* FROM best b LEFT JOIN inside USING (lang, phrase) WHERE inside_a IS NULL OR 100 * inside_a < 100 * b.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept QUALIFY rank <= 2000
    """,
}
