"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), m AS (
  SELECT rid, doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM w
), win AS (
  SELECT rid, i, words[i:i + 7] AS win
  FROM w, LATERAL (SELECT unnest(range(1, len(words) - 6)) AS i)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) WHERE n >= 2
), cover AS (
  SELECT rid, sum(least(8, i - prev)) AS n_repeat_words
  FROM (SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -8) AS prev FROM twice)
  GROUP BY rid
), a AS (
  SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN cover USING (rid)
), b AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > word_chars THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_symbols > n_words THEN 64 ELSE 0 END AS fail_bits
  FROM a
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept,
       CAST(fail_bits AS BIGINT) AS fail_bits
FROM b
"""

OP8 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, hex,
         max(page_id) OVER (PARTITION BY html) AS first
  FROM p
), q AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS INT), 5) AS BIGINT)) AS part
  FROM g
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(part, lambda x:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> 15) & 31 AS INT) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> 10) & 31 AS INT) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> 5) & 31 AS INT) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(x & 31 AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
         CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
  FROM u
), f AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": OP4,
    "op8_warc": OP8,
    "op12_fill_in_middle": OP12,
}
