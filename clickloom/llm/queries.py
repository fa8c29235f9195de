"""Queries of the training-data operators and the SQL that recomputes them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import (
    chat,
    exact_dedup,
    hard_negatives,
    merkle,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
    toxicity,
    url_filters,
    warc,
)
from clickloom.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return chat.format_chats(chat.as_calls(conversations), chat.REPLY_SCHEMAS)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.usable(table(spark, sf_dir, "embeddings")))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_quality_rules": op2_quality_rules,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_url_filters": op4_url_filters,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_packing": op6_packing,
        "op7_token_counts": op7_token_counts,
        "op8_simhash": op8_simhash,
        "op9_chat_formatting": op9_chat_formatting,
        "op10_toxicity": op10_toxicity,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_warc": op12_warc,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": OP2,
        "op3_exact_dedup": OP3,
        "op4_url_filters": OP4,
        "op9_chat_formatting": OP9,
        "op11_hard_negatives": OP11,
        "op12_warc": OP12,
        "op13_merkle": OP13,
    }


OP2 = r"""
WITH counted AS (
    SELECT doc_id,
           coalesce(text, '') AS t,
           regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           len(words) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           length(regexp_replace(t, '[^!]+', '', 'g')) AS n_marks,
           length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
           row_number() OVER () AS uid
    FROM documents
), numbered AS (
    SELECT uid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM counted
), windows AS (
    SELECT uid, pos, lag(word) OVER w = word AS same_word,
           lead(word, 7) OVER w IS NOT NULL AS whole,
           concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w,
                     lead(word, 4) OVER w, lead(word, 5) OVER w, lead(word, 6) OVER w, lead(word, 7) OVER w) AS eight
    FROM numbered
    WINDOW w AS (PARTITION BY uid ORDER BY pos)
), marked AS (
    SELECT uid, pos, same_word, whole AND count(*) OVER (PARTITION BY uid, eight, whole) > 1 AS found_twice FROM windows
), covered AS (
    SELECT uid, same_word,
           coalesce(bool_or(found_twice) OVER (PARTITION BY uid ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), false) AS inside
    FROM marked
), repeats AS (
    SELECT uid, count(*) FILTER (inside) AS n_repeat_words, count(*) FILTER (same_word) AS n_same_words
    FROM covered
    GROUP BY uid
), judged AS (
    SELECT *, coalesce(r.n_repeat_words, 0) AS n_repeats,
           n_words < 20 OR 100 * n_repeats > 30 * n_words AS base_failed
    FROM counted LEFT JOIN repeats r USING (uid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeats AS n_repeat_words, base_failed,
       NOT (base_failed
            OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 6 * n_lines
            OR 10 * n_marks > n_words
            OR 2 * n_capitals > word_chars
            OR 10 * coalesce(n_same_words, 0) > 2 * n_words
            OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words) AS kept
FROM judged
"""

OP3 = r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM hashed
WINDOW same AS (PARTITION BY text_sha256)
"""

OP4 = r"""
WITH cut AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), ruled AS (
    SELECT *,
           '.' || host AS dotted,
           CASE WHEN dotted LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN dotted LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN dotted LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN dotted LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN dotted LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
           END AS rule
    FROM cut
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/fr/', 'org/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN dotted LIKE '%.spam-farm.%' OR dotted LIKE '%.cheap-pills.%' THEN 'block'
            ELSE 'allow'
       END AS verdict
FROM ruled
"""

OP9 = r"""
WITH shaped AS (
    SELECT *,
           row_number() OVER () AS uid,
           CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
           CASE role WHEN 'user' THEN conv_id || ':' || turn
                     WHEN 'assistant' THEN conv_id || ':' || (turn - 1) END AS call_id
    FROM conversations
), used AS (
    SELECT *,
           row_number() OVER (PARTITION BY kind, call_id ORDER BY turn, text) AS use,
           count(*) FILTER (kind = 'call') OVER (PARTITION BY call_id) AS calls,
           count(*) FILTER (kind = 'result') OVER (PARTITION BY call_id) AS results
    FROM shaped
)
SELECT conv_id, turn, kind, call_id,
       CASE WHEN kind = 'message' THEN 'message'
            WHEN call_id IS NULL THEN 'no_id'
            WHEN use > 1 THEN 'repeated'
            WHEN kind = 'call' AND results = 0 THEN 'no_result'
            WHEN kind = 'result' AND calls = 0 THEN 'no_call'
            ELSE 'linked' END AS status,
       CASE WHEN kind = 'call' THEN coalesce(length(text) >= 1, false) ELSE true END AS valid,
       turn AS order_turn,
       0 AS order_level,
       CASE kind
           WHEN 'call' THEN json_object('arguments', json_object('prompt', text, 'turn', turn),
                                        'id', call_id, 'name', 'reply', 'role', role, 'type', 'call')
           WHEN 'result' THEN json_object('content', text, 'id', call_id, 'role', role, 'type', 'result')
           ELSE json_object('content', text, 'role', role, 'type', 'message')
       END::VARCHAR AS line
FROM used
"""

OP11 = r"""
WITH used AS (
    SELECT row_number() OVER () AS uid, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM used a JOIN used b ON a.vec_id % 50 = 0 AND a.uid <> b.uid
), positives AS (
    SELECT *
    FROM scored
    WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
           p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n
      ON n.anchor = p.anchor AND NOT n.same
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked
WHERE rank <= 3
"""

OP12 = r"""
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
           row_number() OVER (PARTITION BY sha256(coalesce(html, '')) ORDER BY page_id) AS place
    FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_value(page_id) OVER same END AS refers_to
FROM hashed
WINDOW same AS (PARTITION BY payload_digest ORDER BY place)
"""


def _merkle_sql(levels: int = 5, upper: int = 4) -> str:
    """SQL of the manifest for up to 16^levels leaves a source and 16^upper sources."""

    def forest(name: str, count: int) -> str:
        """Levels name0, name1, ... and for each the siblings of its nodes (null: a lone node)."""
        parts = []
        for k in range(count):
            parts.append(f"""{name}{k}s AS (
    SELECT *,
           CASE WHEN n > 1 THEN coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
           CASE WHEN n > 1 THEN coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
    FROM {name}{k}
    WINDOW run AS (PARTITION BY tree, pos // 16 ORDER BY pos)
), {name}{k + 1} AS (
    SELECT tree, pos // 16 AS pos, (n + 15) // 16 AS n,
           CASE WHEN n = 1 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash
    FROM {name}{k}
    GROUP BY tree, pos // 16, n
)""")
        return ", ".join(parts)

    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fold, joins, proof, previous = [], [], [], "hash"
    for name, count in (("a", levels), ("b", upper)):
        for k in range(count):
            same = "s.tree IS NOT DISTINCT FROM x.tree AND s.pos = x.pos // " if name == "a" else "s.pos = x.top_pos // "
            joins.append(f"JOIN {name}{k}s AS {name}{k}j ON {same.replace('s.', f'{name}{k}j.')}{16**k}")
            fold.append(f"CASE WHEN {name}{k}j.l IS NULL THEN {previous} ELSE sha256({name}{k}j.l || {previous} || {name}{k}j.r) END AS f{name}{k}")
            proof.append(f"coalesce({name}{k}j.l || {name}{k}j.r, '')")
            previous = f"f{name}{k}"
    return rf"""
WITH leaves AS (
    SELECT doc_id, source AS tree, {leaf("text")} AS hash, {leaf(lowered)} AS lowered_hash,
           -- crc32 bit by bit; a null doc_id has that of nothing, 0
           list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: list_transform(range(8), lambda i: (ascii(c) >> i::INTEGER) & 1))),
               lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1))) AS inverted
    FROM documents
), a0 AS (
    SELECT *, xor(coalesce(inverted, 4294967295), 4294967295) % 5 = 0 AS tampered,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos,
           count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), {forest("a", levels)}, b0 AS (
    SELECT 0 AS tree, tree AS source, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, hash
    FROM a{levels}
), {forest("b", upper)}, x AS (
    SELECT a0.*, b0.pos AS top_pos, b0.hash AS subroot, b{upper}.hash AS root,
           CASE WHEN tampered THEN lowered_hash ELSE a0.hash END AS found
    FROM a0 JOIN b0 ON b0.source IS NOT DISTINCT FROM a0.tree, b{upper}
), folded AS (
    SELECT x.doc_id, x.hash AS leaf, x.subroot, x.root, sha256({" || ".join(proof)}) AS proof_sha256,
           {(", " + chr(10) + "           ").join(fold).replace("THEN hash ELSE", "THEN x.found ELSE").replace("l || hash ||", "l || x.found ||")}
    FROM x {(chr(10) + "         ").join(joins)}
)
SELECT doc_id, leaf, subroot, root, proof_sha256, {previous} AS folded_root, {previous} = root AS verified
FROM folded
"""


OP13 = _merkle_sql()
