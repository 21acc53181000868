"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from .mixing import CURRICULA, inverse_sql

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_TIMES = "CASE shape " + " ".join(f"WHEN {i} THEN {inverse_sql('u', s)}" for i, s in enumerate(CURRICULA)) + " END"

#: Rows of a table ``crc_bytes`` (one list): the CRC-32 step of each byte, from its polynomial.
_CRC_BYTES = """crc_bytes AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, bit: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def _crc32(octets: str) -> str:
    """Unsigned CRC-32 of a list of byte values, ``steps`` being in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda c, o: xor(c >> 8, steps[(xor(c, o) & 255) + 1])), 4294967295::BIGINT)")


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"


def _utf8(text: str) -> str:
    """The UTF-8 bytes of characters up to U+00FF."""
    return (f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN unicode(ch) < 128 "
            "THEN [unicode(ch)::BIGINT] ELSE [(192 | (unicode(ch) >> 6))::BIGINT, (128 | (unicode(ch) & 63))::BIGINT] END))")


SQL: dict[str, str] = {
    "op1_mixing": f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS}) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, rnk % 3 AS shape, (CASE rnk % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END) AS weight,
         source_size * 2e0 AS most,
         source_size * 2e0 / (CASE rnk % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END) AS room
  FROM per_source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5e0
             - coalesce(sum(most) OVER (ORDER BY room, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
          / (sum(weight) OVER ()
             - coalesce(sum(weight) OVER (ORDER BY room, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0)) AS lvl
  FROM weighed),
goal AS (
  SELECT source, source_size, shape,
         coalesce(least(most, weight * (SELECT lvl FROM levels WHERE lvl <= room ORDER BY room, rnk LIMIT 1)), most) AS target
  FROM levels),
seated AS (
  SELECT s.*, g.source_size, g.shape, g.target, floor(g.target)::BIGINT AS goal,
         (sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, (greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - start - source_size)))::BIGINT AS taken,
         start::DOUBLE / goal AS u
  FROM seated)
SELECT doc_id, size::BIGINT AS size, source_size, target, taken,
       CASE WHEN taken > 0 OR (size = 0 AND start < goal) THEN {_TIMES} END AS position
FROM taken
""",
    "op3_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
""",
    "op4_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
pos AS (SELECT rid, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, i
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT *, count(*) OVER (PARTITION BY rid, w1, w2, w3) AS n FROM pos),
rep AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(0, 3) AS r(j) WHERE n > 1 GROUP BY rid),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
          FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
top AS (SELECT rid, max(c) AS top FROM (SELECT rid, x, count(*) AS c FROM (SELECT rid, unnest(w) AS x FROM d) GROUP BY ALL) GROUP BY rid),
again AS (SELECT rid, count(*) AS again FROM (SELECT rid, w, unnest(range(1, len(w))) AS i FROM d) WHERE w[i] = w[i + 1] GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(top, 0) AS top, coalesce(again, 0) AS again,
         length(regexp_replace(text, '[^!]', '', 'g')) AS bangs, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_case,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower_case, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN top USING (rid) LEFT JOIN again USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 4 * n_symbols <= n_words AND 4 * bangs <= n_words AND 2 * upper_case <= upper_case + lower_case
       AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND 2 * n_dup_lines <= n_lines
       AND 5 * again <= n_words AND 3 * top <= n_words AND 5 * digits <= 2 * word_chars AS kept
FROM b
""",
    "op7_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ig AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM iw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id),
dg AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM dw, (SELECT DISTINCT k FROM ig) WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN ig USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item::DOUBLE AS containment
FROM hit JOIN n USING (item_id) WHERE n_shared / n_item::DOUBLE >= 0.8
""",
    "op12_conversation_trie": f"""
WITH {_CRC_BYTES},
own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heirs AS (
  SELECT conv_id, turns, {_crc32(_ascii("conv_id::VARCHAR"))} % 4 AS h FROM own, crc_bytes),
seqs AS (
  SELECT c.conv_id, list_concat(coalesce(d.turns[1:h], []), c.turns[h + 1:]) AS seq
  FROM heirs c LEFT JOIN own d ON d.conv_id = c.conv_id - c.conv_id % 20),
steps AS (
  SELECT conv_id, seq[1:d] AS node, d AS depth, d = len(seq) AS ends
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0
                               ELSE len({WORDS.replace("text", "node[depth].t")}) END AS worth
  FROM steps GROUP BY node, depth),
children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT x.node[1:d] AS node, sum(x.worth) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes) x LEFT JOIN children c ON c.node = x.node GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN children c ON c.node = n.node
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {_CRC_BYTES},
held AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run
        FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, k, len(run) AS n, {_crc32(_utf8("(coalesce(doc_id::VARCHAR, '') || ':' || run)"))} AS h
  FROM held, crc_bytes WHERE len(run) >= 6),
vocabulary AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % n] || run[h % n + 2:] ELSE run END AS word, k FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (
  SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, v.word FROM cut a JOIN vocabulary v ON v.word = a.rest
  UNION SELECT v.word, a.word FROM cut a JOIN vocabulary v ON v.word = a.rest),
best AS (
  SELECT p.word, count(*) AS n_near, min({{'m': -v.n, 'w': encode(p.other)}}) AS top
  FROM pairs p JOIN vocabulary v ON v.word = p.other GROUP BY p.word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.m >= 5 * v.n THEN decode(top.w) END AS form, CASE WHEN -top.m >= 5 * v.n THEN -top.m END AS form_n
  FROM vocabulary v LEFT JOIN best b USING (word)),
ways(word, root, next) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT w.word, w.next, f.form FROM ways w JOIN formed f ON f.word = w.next)
SELECT f.word, form, w.root, n, n_near, form_n
FROM formed f JOIN ways w ON w.word = f.word AND w.next IS NULL""",
}
