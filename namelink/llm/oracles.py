"""The same results as plain SQL, for the queries that SQL can express."""

from .quality import STOP_WORDS

_KNOWN = ", ".join(f"'{w}'" for w in sorted({w for v in STOP_WORDS.values() for w in v.split()}))

OP8 = f"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), repeated AS (
    SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM repeated, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), counts AS (
    SELECT words.doc_id, len(w) AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(w, lambda x: x IN ({_KNOWN}))) AS stop,
           len(lines) AS n_lines,
           len(list_filter(lines, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•'))) AS bullets,
           len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…')) AS ellipses
    FROM words LEFT JOIN covered USING (doc_id)
), ratios AS (
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS mean_word_chars,
           CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbols_per_word,
           CASE WHEN n_words > 0 THEN stop / n_words ELSE 0.0 END AS stop_word_share,
           CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_share,
           CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0.0 END AS bullet_line_share,
           CASE WHEN n_lines > 0 THEN ellipses / n_lines ELSE 0.0 END AS ellipsis_line_share,
           CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeat_word_share
    FROM counts
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           list_filter([
               CASE WHEN n_words < 10 THEN 'n_words' END,
               CASE WHEN n_words >= 10 AND (mean_word_chars < 2.0 OR mean_word_chars > 14.0)
                    THEN 'mean_word_chars' END,
               CASE WHEN symbols_per_word > 0.2 THEN 'symbols_per_word' END,
               CASE WHEN n_words >= 50 AND stop_word_share < 0.02 THEN 'stop_word_share' END,
               CASE WHEN dup_line_share > 0.5 THEN 'dup_line_share' END,
               CASE WHEN n_words >= 50 AND bullet_line_share > 0.9 THEN 'bullet_line_share' END,
               CASE WHEN n_words >= 50 AND ellipsis_line_share > 0.3 THEN 'ellipsis_line_share' END,
               CASE WHEN repeat_word_share > 0.2 THEN 'repeat_word_share' END
           ], lambda x: x IS NOT NULL) AS failed_rules
    FROM ratios
)
SELECT *, NOT base_failed AND len(failed_rules) = 0 AS kept FROM judged
"""

OP6 = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM item_words WHERE len(w) > 0)
), doc_windows AS (
    SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
          FROM doc_words, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)
), found AS (
    SELECT doc_id, i, m, item_id FROM doc_windows JOIN item_windows USING (m, win)
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM found)) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10 = """
WITH all_lines AS (
    SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL)
), firsts AS (
    SELECT line, length(line) AS size, min((doc_id, pos)) AS first
    FROM all_lines WHERE length(line) >= 30 GROUP BY line
), near AS (
    SELECT DISTINCT CASE WHEN a.first > b.first THEN a.line ELSE b.line END AS line
    FROM firsts AS a JOIN firsts AS b
      ON b.size BETWEEN a.size AND a.size + 1 AND a.line <> b.line
     AND (left(a.line, a.size // 2) = left(b.line, a.size // 2)
          OR right(a.line, a.size - a.size // 2) = right(b.line, a.size - a.size // 2))
    WHERE levenshtein(a.line, b.line) <= 1
), judged AS (
    SELECT l.doc_id, l.pos, l.line,
           CASE WHEN length(l.line) < 30 THEN 'k' WHEN f.first <> (l.doc_id, l.pos) THEN 'x'
                WHEN n.line IS NOT NULL THEN 'n' ELSE 'k' END AS state
    FROM all_lines AS l LEFT JOIN firsts AS f USING (line) LEFT JOIN near AS n USING (line)
)
SELECT d.doc_id, count(j.pos) AS n_lines,
       count(*) FILTER (WHERE state = 'x') AS n_dropped_equal,
       count(*) FILTER (WHERE state = 'n') AS n_dropped_near,
       sha256(coalesce(string_agg(j.line, chr(10) ORDER BY j.pos) FILTER (WHERE state = 'k'), '')) AS text_sha256
FROM documents AS d LEFT JOIN judged AS j USING (doc_id) GROUP BY d.doc_id
"""

OP4 = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
), firsts AS (
    SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest,
           min(page_id) OVER (PARTITION BY html) AS first
    FROM payloads
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
               ((('0x' || digest[(i // 4) * 5 + 1:(i // 4) * 5 + 5])::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1]
       ), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

OP13 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# CRC-32 of a decimal id: a step per character and eight shifts after it.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(conv_id::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1])))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END
       ), 4294967295)"""

OP11 = f"""
WITH own AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations GROUP BY conv_id
), rebuilt AS (
    SELECT own.conv_id, list_concat(coalesce(base.turns, [])[1:h], own.turns[h + 1:]) AS path
    FROM (SELECT *, {_CRC32} % 6 AS h FROM own) AS own LEFT JOIN own AS base ON base.conv_id = own.conv_id - own.conv_id % 100
), steps AS (
    SELECT conv_id, len(path) AS n_turns, path[1:d] AS node, d
    FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n_turns = d), '') AS ends
    FROM steps GROUP BY node, d
), linked AS (
    SELECT c.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes AS k WHERE k.d = c.d + 1 AND k.node[1:c.d] = c.node) AS n_children,
           CASE WHEN c.d = 0 THEN 0 ELSE (c.n_convs - 1) * length(c.node[c.d].t) END AS saved
    FROM nodes AS c LEFT JOIN nodes AS p ON p.d = c.d - 1 AND p.node = c.node[1:c.d - 1]
), totals AS (
    SELECT node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT n_children, saved, below[1:d] AS node
          FROM (SELECT n_children, saved, node AS below, unnest(range(0, d + 1)) AS d FROM linked)) GROUP BY node
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN totals USING (node)
"""

ORACLES = {
    "op11_prefix_trie": OP11,
    "op13_exact_dedup": OP13,
    "op4_warc": OP4,
    "op10_line_dedup": OP10,
    "op6_decontaminate": OP6,
    "op8_quality_rules": OP8,
}
