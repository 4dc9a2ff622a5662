"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    bpe_tree,
    decontaminate,
    hard_negatives,
    host_quality,
    katz,
    language_spans,
    resharding,
    tensor_minhash,
    token_counts,
    token_store,
    turn_repair,
    url_rules,
    wrappers,
)
from claimloom.llm.common import columns, read

END_ID = 2


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_tree.digest_documents(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_store.documents(token_store.write(read(spark, sf_dir, "documents"), path, END_ID))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judge_documents(read(spark, sf_dir, "documents"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_spans.identify(read(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_minhash.classes(read(spark, sf_dir, "documents"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(read(spark, sf_dir, "documents"))


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), url_rules.rule_table(spark, url_rules.RULES))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows lost, emptied, without full stops, repeated or given to the user, by a checksum of their key."""
    key = F.concat_ws(":", *[F.coalesce(turns[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(turns[c], F.lit(" ")) for c in ("role", "text"))
    rows = columns(turns, conv_id="conv_id", turn="turn", role=role, text=text, hit=F.crc32(key.cast("binary")) % 20)
    hit = F.col("hit")
    text = F.when(hit == 1, "").when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    kept = rows.filter(hit != 0).select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
                                        text.alias("text"), copies.alias("copy"))
    return kept.drop("copy")


def turn_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return turn_repair.audit_conversations(damaged(turns), turns)


def resharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.grow_documents(read(spark, sf_dir, "documents"))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": byte_bpe,
    "op2_token_counts": counts,
    "op3_token_store": token_files,
    "op4_quality_rules": quality_rules,
    "op5_language": language,
    "op6_near_duplicates": near_duplicates,
    "op7_katz": language_model,
    "op8_decontaminate": benchmark_hits,
    "op9_url_rules": url_verdicts,
    "op10_page_text": page_text,
    "op11_turn_repair": turn_audits,
    "op12_resharding": resharded,
    "op13_hard_negatives": negatives,
}

QUALITY_SQL = r"""
WITH parts AS (
    SELECT doc_id, source, coalesce(text, '') AS body,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, unnest(generate_series(1, len(words) - 4)) AS i, words FROM parts WHERE len(words) >= 5
),
spelled AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w FROM windows),
again AS (SELECT doc_id, unnest(list(i)) AS i FROM spelled GROUP BY doc_id, w HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, i + k AS place FROM again, generate_series(0, 4) AS s(k)),
repeated AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
rules AS (
    SELECT p.doc_id, source, len(words)::BIGINT AS n_words,
        length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM parts p LEFT JOIN repeated r ON p.doc_id = r.doc_id
),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM rules
),
hosts AS (
    SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (WHERE base_failed))::DOUBLE AS failed
    FROM judged WHERE source IS NOT NULL GROUP BY source
),
moments AS (
    SELECT sum(failed) / sum(n) AS mean,
        greatest(0, sum(failed * failed / n) / sum(n) - (sum(failed) / sum(n)) ^ 2) AS spread FROM hosts
),
prior AS (
    SELECT mean, CASE WHEN spread > 0
        THEN least(1e6, greatest(1, mean * (1 - mean) / spread - 1)) ELSE 1e6 END AS strength FROM moments
),
rejected AS (
    SELECT source FROM hosts, prior WHERE (failed + mean * strength) / (n + strength) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(source NOT IN (SELECT source FROM rejected), TRUE) AS kept
FROM judged
"""

_WORDS_SQL = (
    r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

DECONTAMINATE_SQL = rf"""
WITH items AS (
    SELECT item_id::VARCHAR AS item_id, words, least(10, len(words)) AS size
    FROM (SELECT item_id, {_WORDS_SQL} AS words FROM benchmark) WHERE len(words) > 0
),
item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS w
    FROM items, unnest(generate_series(1, len(words) - size + 1)) AS s(i)
),
docs AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents),
doc_windows AS (
    SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS w
    FROM docs, (SELECT DISTINCT size FROM items) AS sizes, unnest(generate_series(1, len(words) - size + 1)) AS s(i)
),
found AS (SELECT doc_id, i, d.size AS size, item_id FROM doc_windows d JOIN item_windows USING (size, w)),
hits AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM found, unnest(generate_series(0, size - 1)) AS s(k) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS listed
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(n.n, 0)::BIGINT AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

URL_SQL = r"""
WITH rules(h, p, given) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
places AS (
    SELECT page_id, url,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
),
best AS (
    SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(given, length(h || p)) AS given
    FROM (SELECT DISTINCT host, path FROM places) JOIN rules
        ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
    GROUP BY host, path
)
SELECT page_id, l.host, l.path, rule, coalesce(given, 'allow') AS verdict
FROM places l LEFT JOIN best b ON l.host = b.host AND l.path = b.path
"""

NEGATIVES_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": QUALITY_SQL,
    "op8_decontaminate": DECONTAMINATE_SQL,
    "op9_url_rules": URL_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
