"""Thin queries opN_<name> over whole tables, and their SQL where SQL can express them.

Each gets its rows from its operator and only derives the columns of its contract."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat_format, line_dedup, lm_scoring, media_ts, minhash_dedup, packing, quality_rules, source_mix, toxicity, warc

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in quality_rules.STOP_WORDS.values() for w in words.split()}))
_FAILS = " OR ".join(
    f"(n_words >= {r.min_words} AND ({' OR '.join([f'{r.statistic} < {r.least}'] * (r.least is not None) + [f'{r.statistic} > {r.most}'] * (r.most is not None))}))" for r in quality_rules.RULES
)
OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
s AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
        len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
        len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS n_ellipsis,
        len(list_filter(lines, lambda x: regexp_matches(x, '^ *[-*•·–]'))) AS n_bullet,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
      FROM w LEFT JOIN rep USING (r)),
v AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_length, coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word,
        coalesce(n_stop / nullif(n_words, 0), 0) AS stop_word_ratio, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS duplicate_line_ratio,
        coalesce(n_ellipsis / nullif(n_lines, 0), 0) AS ellipsis_line_ratio, coalesce(n_bullet / nullif(n_lines, 0), 0) AS bullet_line_ratio,
        coalesce(n_upper / nullif(word_chars, 0), 0) AS upper_case_ratio, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({_FAILS}) AS kept FROM v
"""


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=5, num=85, den=100)


OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
c AS (SELECT doc_id AS v, doc_id AS root FROM documents UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.v)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT v, min(root) AS component_id FROM c GROUP BY v) m ON m.v = d.doc_id
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, labels, folds=5, held_fold=0).select("doc_id", "held_out", "score", "predicted")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"), least=10).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line, lower_key, length(lower_key) AS n FROM (
    SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents))),
shared AS (SELECT lower_key, min(doc_id) AS owner FROM l WHERE n >= 10 GROUP BY lower_key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT l.*, s.owner IS NOT NULL AND s.owner <> l.doc_id AS dropped FROM l LEFT JOIN shared s ON l.n >= 10 AND l.lower_key = s.lower_key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), folds=5, held_fold=1)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", ok), (-1, 1, "assistant", ok)], "conv_id long, turn long, role string, text string")
    path = public_tokenizers.path(TOKENIZER)
    read = chat_format.read_conversations(chat_format.format_conversations(turns.unionByName(planted), path), path)
    return read.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


_MARKED = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in chat_format.CONTROL)
OP6_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (SELECT *, {len(chat_format.TURN + chat_format.TEXT + chat_format.END)} + length(role) + length(text)
        + len(regexp_extract_all(role, '{_MARKED}')) + len(regexp_extract_all(text, '{_MARKED}')) AS chars FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_epochs=3).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('mix:' || doc_id) AS place, text FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, (i - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s),
o AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0))::BIGINT AS budget, (sum(w) OVER () - coalesce(sum(w) OVER p, 0))::BIGINT AS weight
      FROM w WINDOW p AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, w * budget > cap * weight AS capped FROM o),
u AS (SELECT sum(source_size)::BIGINT - coalesce(sum(cap) FILTER (capped), 0)::BIGINT AS budget, coalesce(sum(w) FILTER (NOT capped), 0)::BIGINT AS weight FROM f),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (w * u.budget)::DOUBLE / u.weight END AS target FROM f, u),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
a AS (SELECT d.doc_id, size, source_size, target, whole, target - whole * source_size AS need,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, d.doc_id, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN need > 0 AND ahead + size / 2 <= need THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM a
"""


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=2048, end_id=0)


def op9_media_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_ts.media_features(media_ts.store_media(table(spark, sf_dir, "documents")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(spark, warc.write_archives(table(spark, sf_dir, "pages"), min_bytes=0))


OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS newest,
             list_transform(range(8), lambda i: ('0x' || substr(h, i * 5 + 1, 5))::INT) AS g FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (g[k // 4 + 1] >> (15 - 5 * (k % 4))) % 32 + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_chat_format": op6_chat_format,
    "op7_source_mix": op7_source_mix,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_media_ts": op9_media_ts,
    "op10_warc": op10_warc,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op2_minhash_dedup": OP2_SQL,
    "op4_line_dedup": OP4_SQL,
    "op6_chat_format": OP6_SQL,
    "op7_source_mix": OP7_SQL,
    "op10_warc": OP10_SQL,
}
