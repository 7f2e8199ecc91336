"""SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n
  FROM places
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest(range(8)) AS k FROM windows WHERE n > 1) GROUP BY doc_id
), base AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS k
  FROM judged GROUP BY source
), total AS (
  SELECT sum(k) / sum(n) AS mean, sum(n) - sum(n * n) / sum(n) AS divisor, count(*) AS h FROM hosts
), prior AS (
  SELECT any_value(mean) AS mean, any_value(mean * (1 - mean)) AS within, any_value(divisor) AS divisor,
    sum(n * (k / n - mean) ** 2) - any_value((h - 1) * mean * (1 - mean)) AS extra
  FROM hosts, total
), fitted AS (
  SELECT mean, within, least(greatest(
    CASE WHEN divisor > 0 THEN extra / divisor ELSE 0 END, within * 1e-4), within * 0.99) AS spread
  FROM prior
), rates AS (
  SELECT source, (k + s * mean) / (n + s) AS rate
  FROM hosts, (SELECT mean, CASE WHEN spread > 0 THEN within / spread - 1 ELSE 1 END AS s FROM fitted)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= 0.5 AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

SOURCE_MIXING = rf"""
WITH sizes AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank
  FROM sizes GROUP BY source
), room AS (
  SELECT *, source_size * 2.0::DOUBLE AS room,
    CASE source_rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM totals
), leveled AS (
  SELECT *, ((SELECT sum(source_size) FROM room) * 1.5::DOUBLE - coalesce(sum(room) OVER (
      ORDER BY room / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (
      ORDER BY room / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM room
), targets AS (
  SELECT source, source_rank, source_size, least(room, weight * coalesce(
    (SELECT max(level) FROM leveled WHERE level * weight <= room),
    (SELECT max(room / weight) FROM leveled))) AS target
  FROM leveled
), queue AS (
  SELECT doc_id, size, source_rank, source_size, target, md5(doc_id::VARCHAR) AS key,
    sum(size) OVER (PARTITION BY source_rank ORDER BY md5(doc_id::VARCHAR), doc_id, size) AS done
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
), events AS (
  SELECT doc_id, size, turn, source_rank, key, (done + turn * source_size)::DOUBLE / target AS finish
  FROM queue, (SELECT unnest([0, 1]) AS turn) WHERE size > 0
), served AS (
  SELECT doc_id, size, sum(size) OVER (
    ORDER BY finish, source_rank, turn, key, doc_id, size) AS served
  FROM events
), taken AS (
  SELECT doc_id, sum(size) AS taken FROM served
  WHERE served <= (SELECT sum(source_size) FROM room) * 1.5 GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM queue LEFT JOIN taken USING (doc_id)
"""

# The checksum of a text of ASCII characters, byte by byte over a table of 256 steps.
_CRC_TABLE = """
crc AS (
  SELECT list(step ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step
    FROM (SELECT unnest(range(256)) AS i))
)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: "
        "xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"
    )


# What stands last: 0 nothing, 1 system, 2 user, 3 assistant.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE}, given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), fated AS (
  SELECT conv_id, turn, role, text, {_crc32("key")} % 20 AS fate FROM given, crc
), damaged AS (
  SELECT conv_id, turn, copy, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
      ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM fated WHERE fate > 0)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged
), marked AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
      WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 'truncated'
      ELSE '' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before
  FROM placed
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), turns(p, q) AS (
  VALUES (0, 2), (1, 2), (3, 2), (2, 3)
), inserted AS (
  SELECT p, p AS q, 0 AS cost, '' AS edits, []::VARCHAR[] AS lines FROM (SELECT unnest(range(4)) AS p)
  UNION ALL SELECT p, q, 5, 'I', [CASE q WHEN 2 THEN 'user:' ELSE 'assistant:' END] FROM turns
  UNION ALL SELECT x.p, y.q, 10, 'II',
    CASE y.q WHEN 3 THEN ['user:', 'assistant:'] ELSE ['assistant:', 'user:'] END
  FROM turns x JOIN turns y ON x.q = y.p
), edits AS (
  SELECT p, p AS q, 2 AS cost, 'D' AS edit, '' AS name FROM (SELECT unnest(range(4)) AS p)
  UNION ALL SELECT p, q, 1, 'R', CASE q WHEN 2 THEN 'user' ELSE 'assistant' END FROM turns
  UNION ALL SELECT p, q, 0, 'K', CASE q WHEN 2 THEN 'u' ELSE 'a' END FROM turns
  UNION ALL SELECT 0, 1, 0, 'K', 's'
), steps AS (
  SELECT x.p, y.q, x.cost + y.cost AS cost, x.edits || y.edit AS edits, x.lines, y.edit, y.name
  FROM inserted x JOIN edits y ON x.q = y.p
), best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines
  FROM counts
  UNION ALL
  SELECT conv_id, i, state, least.cost, least.audit, least.lines FROM (
    SELECT b.conv_id, m.i, s.q AS state, min(struct_pack(
      cost := b.cost + s.cost + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
      audit := b.audit || s.edits,
      lines := b.lines || s.lines || CASE edit WHEN 'D' THEN []::VARCHAR[]
        WHEN 'K' THEN [role || ':' || text] ELSE [name || ':' || text] END)) AS least
    FROM best b JOIN marked m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i + 1
    JOIN steps s ON s.p = b.state
      AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR name = initial))
    GROUP BY b.conv_id, m.i, s.q)
), repaired AS (
  SELECT b.conv_id, min(struct_pack(cost := b.cost + x.cost, audit := b.audit || x.edits,
    lines := b.lines || x.lines)) AS least
  FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i
  JOIN inserted x ON x.p = b.state AND x.q IN (0, 3)
  GROUP BY b.conv_id
)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(least.cost, 0)::BIGINT AS cost,
  coalesce(least.audit, '') AS audit,
  sha256(coalesce(array_to_string(least.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM g.conv_id
"""

PREFIX_TRIE = rf"""
WITH {_CRC_TABLE}, own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc
), turns AS (
  SELECT c.conv_id, 0 AS part, pos, role, text
  FROM convs c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
  UNION ALL
  SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN own USING (conv_id) WHERE pos > h
), paths AS (
  SELECT c.conv_id, coalesce(path, []) AS path FROM convs c LEFT JOIN (
    SELECT conv_id, list(struct_pack(role, text) ORDER BY part, pos) AS path
    FROM turns GROUP BY conv_id) USING (conv_id)
), prefixes AS (
  SELECT conv_id AS member, path, unnest(range(len(path) + 1)) AS depth FROM paths
), nodes AS (
  SELECT path[1:depth] AS prefix, depth, min(member) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (len(path) = depth), '') AS ends
  FROM prefixes GROUP BY path[1:depth], depth
), counted AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    CASE WHEN n.depth = 0 THEN 0 ELSE
      (n.n_convs - 1) * len(regexp_extract_all(n.prefix[n.depth].text, '[^ 	-]+')) END AS saved
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
), children AS (
  SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL
), sums AS (
  SELECT prefix[1:top] AS prefix, top AS depth, sum(saved) AS saved_tokens,
    count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT c.*, n_children, unnest(range(c.depth + 1)) AS top
        FROM counted c LEFT JOIN children k ON k.depth = c.depth AND k.prefix = c.prefix)
  GROUP BY prefix[1:top], top
)
SELECT c.conv_id, c.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted c JOIN sums s ON s.depth = c.depth AND s.prefix = c.prefix
LEFT JOIN children k ON k.depth = c.depth AND k.prefix = c.prefix
"""

ORACLE = {
    "op8_quality_rules": QUALITY_RULES,
    "op10_source_mixing": SOURCE_MIXING,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op13_prefix_trie": PREFIX_TRIE,
}
