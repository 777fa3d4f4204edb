"""DuckDB statements of the operators whose results SQL can express (operators 12 and 13).

Operator 12 runs its dynamic program forward over each conversation's symbols: per state the cheapest audit so far as one string,
eight digits of cost and then the letters, so ``least`` picks the cheaper and of equals the ASCII-least one. Operator 13
groups all prefixes and joins nodes with their ancestors.
"""

from __future__ import annotations

CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, n: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS i)))"""


def crc32_of(text: str) -> str:
    """CRC-32 of an ASCII string expression, with ``crc_table`` beside it."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _add(key, letter, cost):
    return f"(lpad((left({key}, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || substr({key}, 9) || '{letter}')"


def _insert(key):
    return _add(key, "I", 3)


def _delete(key):
    return _add(key, "D", 4)


def _keep(key, kind):
    return f"CASE WHEN x[1] = '{kind}' THEN lpad((left({key}, 8)::BIGINT + x[2]::BIGINT)::VARCHAR, 8, '0') || substr({key}, 9) || 'K' END"


def _rerole(key):
    return f"CASE WHEN x[1] <> 'd' THEN lpad((left({key}, 8)::BIGINT + 3 + x[2]::BIGINT)::VARCHAR, 8, '0') || substr({key}, 9) || 'R' END"


_INSERTS = f"[a[1], a[2], least(a[3], {_insert('a[1]')}, {_insert('a[2]')}, {_insert('a[4]')}), least(a[4], {_insert('a[3]')}, {_insert(_insert('a[1]'))}, {_insert(_insert('a[2]'))})]"
_MOVES = f"""[{_delete('a[1]')},
  least({_delete('a[2]')}, {_keep('a[1]', 's')}),
  least({_delete('a[3]')}, {_keep('a[1]', 'u')}, {_keep('a[2]', 'u')}, {_keep('a[4]', 'u')}, {_rerole('a[1]')}, {_rerole('a[2]')}, {_rerole('a[4]')}),
  least({_delete('a[4]')}, {_keep('a[3]', 'a')}, {_rerole('a[3]')})]"""
WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12 = f"""WITH {CRC_TABLE},
given AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_of("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS h
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM given WHERE h <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
marked AS (
  SELECT *,
         CASE WHEN trim(text, {WHITE}) = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(rtrim(text, {WHITE}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
pairs AS (SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM marked),
seqs AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list(CASE WHEN fault IN ('blank', 'duplicate') THEN ['d', '0']
                   ELSE [CASE WHEN left(role, 1) IN ('u', 'a', 's') THEN left(role, 1) ELSE 'x' END, CASE fault WHEN 'truncated' THEN '3' ELSE '0' END] END ORDER BY i) AS symbols
  FROM pairs GROUP BY conv_id),
solved AS (
  SELECT *, least(f[1], f[4]) AS best FROM (
    SELECT *, list_reduce(list_concat([['00000000', NULL, NULL, NULL], ['I']], flatten(list_transform(symbols, lambda y: [y, ['I']]))),
                          lambda a, x: CASE WHEN x[1] = 'I' THEN {_INSERTS} ELSE {_MOVES} END) AS f FROM seqs)),
letters AS (SELECT conv_id, unnest(range(1, len(best) - 7)) AS j, substr(best, 8 + unnest(range(1, len(best) - 7)), 1) AS letter FROM solved WHERE len(best) > 8),
steps AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
kept AS (
  SELECT s.conv_id, s.j, s.letter, s.o, m.role, CASE WHEN s.letter = 'I' THEN '' ELSE m.text END AS text
  FROM steps s LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i AND s.letter <> 'I' WHERE s.letter <> 'D'),
led AS (SELECT *, max(CASE WHEN o = 1 AND letter = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS lead FROM kept),
fixed AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS t
  FROM led GROUP BY conv_id)
SELECT g.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate,
       coalesce(s.truncated, 0)::BIGINT AS truncated, coalesce(s.illegal, 0)::BIGINT AS illegal, coalesce(left(s.best, 8)::BIGINT, 0) AS cost,
       coalesce(substr(s.best, 9), '') AS audit, sha256(coalesce(f.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM given) g LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM g.conv_id"""

OP13 = f"""WITH {CRC_TABLE},
own AS (
  SELECT conv_id::BIGINT AS conv_id, list({{'h': md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))), 'n': length(coalesce(text, ''))}}
         ORDER BY turn NULLS FIRST, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, ({crc32_of('conv_id::VARCHAR')} % 6)::BIGINT AS h FROM own, crc_table),
seqs AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, c.turns[1:0]), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM h c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
cells AS (
  SELECT conv_id, d, len(turns) AS size, md5(list_reduce(list_concat([''], list_transform(turns[1:d], lambda x: x.h)), lambda a, b: a || b)) AS node,
         CASE WHEN d > 0 THEN md5(list_reduce(list_concat([''], list_transform(turns[1:d - 1], lambda x: x.h)), lambda a, b: a || b)) END AS parent,
         CASE WHEN d > 0 THEN turns[d].n ELSE 0 END AS n
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS chars, min(conv_id) AS witness,
         sha256(coalesce(string_agg(CASE WHEN d = size THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM cells GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
  SELECT a.node, sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved_tokens
  FROM nodes x JOIN cells a ON a.conv_id = x.witness AND a.d <= x.depth LEFT JOIN kids k ON k.node = x.node GROUP BY a.node)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM nodes x JOIN sums s ON s.node = x.node LEFT JOIN nodes p ON p.node = x.parent LEFT JOIN kids k ON k.node = x.node"""

ORACLE_SQL = {"op12_conversation_repair": OP12, "op13_prefix_trie": OP13}
