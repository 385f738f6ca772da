"""SQL for the queries that SQL can express, over the plain tables."""

from __future__ import annotations

from trailmark.llm.decontaminate import NUMBERS, UNITS
from trailmark.llm.quality_rules import EDGES, STOP_WORDS

#: CRC-32 of a text, byte by byte and bit by bit.
_CRC = """CAST(xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
  lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295) AS BIGINT)"""

OP3 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(doc_id, 0) AS k FROM documents
), jump AS (
  SELECT r, n, (CAST(k AS HUGEINT) + 18446744073709551616) % 18446744073709551616 AS s, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j
  FROM d, (VALUES (24), (25)) v(n)
  UNION ALL
  SELECT r, n, (s * 2862933555777941757 + 1) % 18446744073709551616, j,
    CAST(floor((j + 1) * (CAST(2147483648 AS DOUBLE) / CAST(((s * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM jump WHERE j < n
), placed AS (
  SELECT r, max(CASE WHEN n = 24 THEN b END) AS shard, max(CASE WHEN n = 25 THEN b END) AS grown
  FROM jump WHERE j >= n GROUP BY r
), rows AS (
  SELECT doc_id, k, strlen(t) + 8 AS size, {_CRC} AS crc, shard, grown,
    (((CAST(k AS HUGEINT) + 18446744073709551616) % 18446744073709551616) * 2862933555777941757 + 1) % 18446744073709551616 // 18014398509481984 AS slice
  FROM d JOIN placed USING (r)
)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id NULLS FIRST, size, crc) - 1 AS BIGINT) AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM rows
"""

OP5 = """
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), heads AS (
  SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) AS head,
    CRC_OF_URL % 97 = 0 AS damaged
  FROM p
), records AS (
  SELECT *, head || html || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM heads
), laid AS (
  SELECT *, CAST(floor(page_id / 1000) AS BIGINT) AS file_no,
    row_number() OVER f - 1 AS record_no, sum(strlen(record)) OVER (PARTITION BY floor(page_id / 1000) ORDER BY page_id ROWS UNBOUNDED PRECEDING) AS stop
  FROM records WINDOW f AS (PARTITION BY floor(page_id / 1000) ORDER BY page_id)
)
SELECT page_id, file_no, CAST(record_no AS BIGINT) AS record_no, CAST(stop - strlen(record) AS BIGINT) AS offset_start, CAST(stop AS BIGINT) AS offset_stop,
  'changed' AS fault, sha256(record) AS sha256,
  sha256(head || chr(1) || substr(html, 2) || chr(13) || chr(10) || chr(13) || chr(10)) AS replica_sha256
FROM laid WHERE damaged AND html <> chr(1) || substr(html, 2)
""".replace("CRC_OF_URL", _CRC.replace("encode(t)", "encode(url)"))

_LIST = "(" + ", ".join(f"'{w}'" for w in UNITS) + ")"
_NUMBERS = "(" + ", ".join(f"'{w}'" for w in NUMBERS) + ")"
_RAW = r"""list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
  '([0-9])[.,:]([0-9])', '\1_\2', 'g'), '([0-9])[.,:]([0-9])', '\1_\2', 'g'), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), lambda w: w <> '')"""
_TYPED = f"""CASE WHEN w[1] BETWEEN '0' AND '9' OR lower(w) IN {_NUMBERS} THEN '#number' WHEN lower(w) IN {_LIST} THEN '#unit'
  WHEN w[1] <> lower(w[1]) THEN '#name' ELSE lower(w) END"""

OP6 = f"""
WITH item_tokens AS (
  SELECT item_id, {_RAW} AS raw FROM benchmark
), doc_tokens AS (
  SELECT doc_id, {_RAW} AS raw FROM documents
), item_rows AS (
  SELECT DISTINCT item_id, pos, raw[pos : pos + 7] AS item_raw
  FROM (SELECT item_id, raw, unnest(generate_series(1, len(raw) - 7)) AS pos FROM item_tokens WHERE len(raw) >= 8)
), item_windows AS (
  SELECT *, list_transform(item_raw, lambda w: {_TYPED}) AS template FROM item_rows
), windows AS (
  SELECT * FROM item_windows WHERE len(list_filter(template, lambda x: NOT starts_with(x, '#'))) >= 3
), doc_typed AS (
  SELECT doc_id, raw, list_transform(raw, lambda w: {_TYPED}) AS template FROM doc_tokens WHERE len(raw) >= 8
), doc_windows AS (
  SELECT doc_id, pos, raw[pos : pos + 7] AS raw, template[pos : pos + 7] AS template
  FROM (SELECT doc_id, raw, template, unnest(generate_series(1, len(raw) - 7)) AS pos FROM doc_typed)
), tokens AS (
  SELECT DISTINCT doc_id, item_id, shift, item_pos + k AS token, ours[k + 1] AS ours, theirs[k + 1] AS theirs, template[k + 1] AS slot
  FROM (SELECT d.doc_id, w.item_id, d.pos - w.pos AS shift, w.pos AS item_pos, d.raw AS ours, w.item_raw AS theirs, w.template,
          unnest(range(8)) AS k FROM doc_windows d JOIN windows w USING (template))
), broken AS (
  SELECT DISTINCT doc_id, item_id, shift FROM tokens WHERE starts_with(slot, '#')
  GROUP BY doc_id, item_id, shift, slot, theirs HAVING count(DISTINCT ours) > 1
), ways AS (
  SELECT doc_id, item_id, shift, count(DISTINCT token) AS n, bool_or(starts_with(slot, '#') AND ours <> theirs) AS reworded
  FROM tokens t WHERE NOT EXISTS (SELECT 1 FROM broken b WHERE b.doc_id = t.doc_id AND b.item_id = t.item_id AND b.shift = t.shift)
  GROUP BY ALL
), best AS (
  SELECT doc_id, item_id, bool_and(reworded) AS reworded FROM ways w
  WHERE n = (SELECT max(n) FROM ways x WHERE x.doc_id = w.doc_id AND x.item_id = w.item_id) GROUP BY ALL
), covered AS (
  SELECT doc_id, item_id, count(DISTINCT token) AS matched_tokens FROM tokens SEMI JOIN ways USING (doc_id, item_id, shift) GROUP BY ALL
), sizes AS (
  SELECT item_id, count(DISTINCT pos + k) AS item_tokens FROM (SELECT item_id, pos, unnest(range(8)) AS k FROM windows) GROUP BY ALL
)
SELECT doc_id, item_id, matched_tokens, item_tokens, round(matched_tokens / item_tokens, 6) AS coverage, reworded
FROM covered JOIN sizes USING (item_id) JOIN best USING (doc_id, item_id)
WHERE matched_tokens / item_tokens >= 0.5 OR matched_tokens >= 13
"""

OP7 = r"""
WITH plain AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
), told AS (
  SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
  FROM plain WINDOW best AS (PARTITION BY body ORDER BY length(t) DESC, doc_id NULLS LAST)
)
SELECT * FROM told
"""

_STOPS = "(" + ", ".join(sorted({f"'{w}'" for line in STOP_WORDS.values() for w in line.split()})) + ")"
_EDGES = EDGES.replace("'", "''")

OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, p, words[p : p + 2] AS win FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS p FROM cut WHERE len(words) >= 3)
), twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n >= 2
), repeats AS (
  SELECT r, count(DISTINCT p + k) AS n FROM (SELECT r, p, unnest([0, 1, 2]) AS k FROM twice) GROUP BY r
), counted AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: lower(trim(w, '{_EDGES}')) IN {_STOPS})) AS n_stop_words, len(lines) AS n_lines,
    len(regexp_extract_all(t, '!')) AS marks, len(list_filter(lines, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•', '·'))) AS bullets,
    len(list_filter(lines, lambda x: rtrim(x, ' ').ends_with('...') OR rtrim(x, ' ').ends_with('…'))) AS cut_off
  FROM cut LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, list_filter([
    CASE WHEN n_words < 50 THEN 'too_short' END, CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_words' END,
    CASE WHEN n_words > 0 AND word_chars NOT BETWEEN 2 * n_words AND 14 * n_words THEN 'word_length' END,
    CASE WHEN 4 * n_symbols > n_words AND n_words > 0 THEN 'symbols' END, CASE WHEN 2 * marks > n_words AND n_words > 0 THEN 'shouting' END,
    CASE WHEN 100 * n_stop_words < n_words THEN 'no_stop_words' END, CASE WHEN 2 * n_dup_lines > n_lines THEN 'repeated_lines' END,
    CASE WHEN 10 * bullets > 9 * n_lines THEN 'bullets' END, CASE WHEN 2 * cut_off > n_lines THEN 'cut_lines' END
  ], lambda x: x IS NOT NULL) AS failed FROM counted
)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines,
  array_to_string(failed, ';') AS failed_rules, list_has_any(failed, ['too_short', 'repeated_words']) AS base_failed, len(failed) = 0 AS kept
FROM judged
"""

_CRC_OF_TURN = _CRC.replace("encode(t)", "encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")

#: The DP over all edits with up to two insertions before any row, every state with its whole edit text.
OP12 = rf"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC_OF_TURN} % 20 AS mark FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN mark = 4 THEN 'user' ELSE role END AS role,
    CASE mark WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN mark = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM marked WHERE mark <> 0
), placed AS (
  SELECT *, row_number() OVER c AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) AS nth,
    lag(role[1]) OVER c || role[1] AS pair, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), time)
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), states(s, after) AS (
  VALUES (0, 2), (1, 2), (2, 3), (3, 2)
), inserted(s, word, said, price, pos) AS (
  SELECT s, '', '', 0, s FROM states
  UNION ALL SELECT s, 'I', CASE after WHEN 2 THEN 'user:' ELSE 'assistant:' END || chr(10), 5, after FROM states
  UNION ALL SELECT a.s, 'II', CASE a.after WHEN 2 THEN 'user:' ELSE 'assistant:' END || chr(10) || CASE b.after WHEN 2 THEN 'user:' ELSE 'assistant:' END || chr(10), 10, b.after
    FROM states a JOIN states b ON b.s = a.after
), kept(s, first, t) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), moves AS (
  SELECT s, word || 'D' AS word, said, price + 2 AS price, pos AS t, CAST(NULL AS VARCHAR) AS first, 'D' AS edit FROM inserted
  UNION ALL SELECT i.s, word || 'R', said, price + 1, after, NULL, 'R' FROM inserted i JOIN states n ON n.s = i.pos
  UNION ALL SELECT i.s, word || 'K', said, price, t, first, 'K' FROM inserted i JOIN kept k ON k.s = i.pos
), sizes AS (
  SELECT conv_id, count(*) AS n FROM faults GROUP BY conv_id
), ways AS (
  SELECT conv_id, 0 AS i, 0 AS s, {{'cost': 0, 'audit': '', 'said': ''}} AS best FROM sizes
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.t,
    min({{'cost': w.best.cost + m.price + CASE WHEN f.fault = 'truncated' AND m.edit <> 'D' THEN 5 ELSE 0 END, 'audit': w.best.audit || m.word,
      'said': w.best.said || m.said || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
        ELSE CASE m.t WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text || chr(10) END}})
  FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN moves m ON m.s = w.s
  WHERE (m.edit <> 'K' OR m.first = f.role[1]) AND (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.i, m.t
), closed AS (
  SELECT w.conv_id, min({{'cost': best.cost + price, 'audit': best.audit || word, 'said': best.said || said}}) AS best
  FROM ways w JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.i JOIN inserted x ON x.s = w.s WHERE x.pos IN (0, 3) GROUP BY w.conv_id
), told AS (
  SELECT conv_id, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM faults GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(left(best.said, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN closed x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLES = {
    "op3_jump_sharding": OP3,
    "op5_merkle_fixity": OP5,
    "op6_template_decontamination": OP6,
    "op7_exact_dedup": OP7,
    "op11_quality_rules": OP11,
    "op12_conversation_repair": OP12,
}
