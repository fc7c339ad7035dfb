"""DuckDB SQL whose rows those of the queries must equal, where SQL can express them."""
from __future__ import annotations


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(
    list_prepend(4294967295::BIGINT, [CAST(ascii(substr({text}, i, 1)) AS BIGINT) FOR i IN range(1, CAST(length({text}) AS BIGINT) + 1)]),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""


TRIE = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, substr(sha256(strlen(r) || ':' || r || t), 1, 32)) AS seq FROM turns GROUP BY conv_id),
h AS (
  SELECT *, {crc} % 4 AS h
  FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.seq[1:a.h], []), a.seq[a.h + 1:]) AS seq
  FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
places AS (
  SELECT conv_id, len(seq) AS n, d, sha256(CAST(seq[1:d] AS VARCHAR)) AS node, CASE WHEN d > 0 THEN sha256(CAST(seq[1:d - 1] AS VARCHAR)) END AS parent,
         CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words
  FROM (SELECT conv_id, seq, unnest(range(0, CAST(len(seq) AS BIGINT) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(words) AS saved,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM places GROUP BY d, node),
counted AS (
  SELECT a.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.d = a.d + 1 AND c.parent = a.node) AS children
  FROM nodes a LEFT JOIN nodes p ON p.d = a.d - 1 AND p.node = a.parent),
-- Each node with all nodes over it, which are those of any of its members.
over AS (
  SELECT DISTINCT a.d, a.node, b.d AS below_d, b.node AS below FROM places a JOIN places b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
  SELECT o.d, o.node, sum(CASE WHEN c.children = 0 THEN 1 ELSE 0 END) AS leaves, sum(c.saved) AS saved
  FROM over o JOIN counted c ON c.d = o.below_d AND c.node = o.below GROUP BY o.d, o.node)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, c.parent_conv_id, c.n AS n_convs, c.children AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN sums s ON s.d = c.d AND s.node = c.node""".replace("{crc}", _crc32("CAST(conv_id AS VARCHAR)"))

MERKLE = """
WITH RECURSIVE bytes AS (
  SELECT *, CAST(doc_id AS VARCHAR) AS t FROM documents),
crc AS (
  SELECT *, CASE WHEN t IS NULL THEN NULL ELSE {crc} END AS crc
  FROM bytes),
parts AS (
  SELECT doc_id, lang, coalesce(crc % 7 = 0, false) AS hit,
    coalesce(strlen(t) || ':' || t, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS before,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS n,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') AS n1,
    coalesce(strlen(text) || ':' || text, '-') AS after
  FROM crc),
leaves AS (
  SELECT doc_id, lang, sha256(before || n || after) AS leaf, sha256(before || CASE WHEN hit THEN n1 ELSE n END || after) AS found
  FROM parts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
low(lang, l, ds) AS (
  SELECT lang, 0, list(leaf ORDER BY place) FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, l + 1, [sha256(ds[2 * i + 1] || coalesce(ds[2 * i + 2], '')) FOR i IN range(0, CAST((len(ds) + 1) // 2 AS BIGINT))] FROM low WHERE len(ds) > 1),
subroots AS (
  SELECT lang, ds[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM low WHERE len(ds) = 1),
top(l, ds) AS (
  SELECT 0, list(subroot ORDER BY place) FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT l + 1, [sha256(ds[2 * i + 1] || coalesce(ds[2 * i + 2], '')) FOR i IN range(0, CAST((len(ds) + 1) // 2 AS BIGINT))] FROM top WHERE len(ds) > 1),
-- Each step: L or R, the side that the sibling stands on, and the sibling.
upper AS (
  SELECT s.lang, list(CASE WHEN (s.place >> l) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(ds[xor(s.place >> l, 1) + 1], '') ORDER BY l) AS steps
  FROM subroots s JOIN top ON len(ds) > 1 GROUP BY s.lang),
lower AS (
  SELECT p.lang, p.place, list(CASE WHEN (p.place >> l) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(ds[xor(p.place >> l, 1) + 1], '') ORDER BY l) AS steps
  FROM placed p JOIN low ON low.lang IS NOT DISTINCT FROM p.lang AND len(ds) > 1 GROUP BY p.lang, p.place),
paths AS (
  SELECT p.*, s.subroot, list_concat(coalesce(w.steps, CAST([] AS VARCHAR[])), coalesce(u.steps, CAST([] AS VARCHAR[]))) AS steps
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN lower w ON w.lang IS NOT DISTINCT FROM p.lang AND w.place = p.place
  LEFT JOIN upper u ON u.lang IS NOT DISTINCT FROM p.lang),
done AS (
  SELECT *, (SELECT ds[1] FROM top WHERE len(ds) = 1) AS root,
    list_reduce(list_prepend(found, steps), lambda a, s: CASE WHEN s[1] = 'L' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END) AS folded_root
  FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([s[2:] FOR s IN steps], '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM done""".replace("{crc}", _crc32("t"))
