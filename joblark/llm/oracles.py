"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *, 3 + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE 12 + escaped(role) END + escaped(text) AS chars,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(coalesce(before, 'start') || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (back > 1 OR role IN ('user', 'assistant'))) AS valid
FROM sized GROUP BY conv_id
""".replace("escaped(role)", "(length(role) + {0})").replace("escaped(text)", "(length(text) + {1})").format(
    *(
        f"length({c}) - length(replace({c}, chr(92), '')) + "
        + " + ".join(f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]"))
        for c in ("role", "text")
    )
)

OP6 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[p + 1 : p + 10], ' ') AS g
  FROM (SELECT item, ws, unnest(generate_series(0, greatest(len(ws) - 10, 0))) AS p FROM b WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, p, array_to_string(ws[p + 1 : p + n], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(generate_series(0, len(ws) - n)) AS p FROM d, sizes WHERE len(ws) >= n)
),
hits AS (SELECT doc_id, item, p, n FROM places JOIN windows USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS w FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
grams AS (
  SELECT doc_id, unnest(generate_series(0, length(h) // 2 - 100)) AS p, h FROM d WHERE length(h) >= 200
),
windows AS (SELECT doc_id, p, md5_number(substring(h, 2 * p + 1, 200)) AS g FROM grams),
later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
),
edges AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER w + 100 THEN 0 ELSE 1 END AS opens FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)
),
numbered AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM edges),
runs AS (SELECT doc_id, run, min(p) AS b, max(p) + 100 AS e FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT r.doc_id, r.b, r.e, substring(d.h, 2 * coalesce(lag(r.e) OVER w, 0) + 1, 2 * (r.b - coalesce(lag(r.e) OVER w, 0))) AS before
  FROM runs r JOIN d USING (doc_id) WINDOW w AS (PARTITION BY r.doc_id ORDER BY r.b)
),
cut AS (
  SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS tail, string_agg(before, '' ORDER BY b) AS kept FROM gaps GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN tail IS NULL THEN d.h ELSE kept || substring(d.h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
windows AS (
  SELECT doc_id, p, md5_number(array_to_string(ws[p + 1 : p + 35], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(0, len(ws) - 35)) AS p FROM d WHERE len(ws) >= 35)
),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY g) AS k FROM windows) WHERE k > 1),
edges AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER w + 35 THEN 0 ELSE 1 END AS opens FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY p)
),
numbered AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM edges),
runs AS (SELECT doc_id, run, min(p) AS b, max(p) + 35 AS e FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT r.doc_id, r.b, r.e, d.ws[coalesce(lag(r.e) OVER w, 0) + 1 : r.b] AS before
  FROM runs r JOIN d USING (doc_id) WINDOW w AS (PARTITION BY r.doc_id ORDER BY r.b)
),
cut AS (
  SELECT doc_id, sum(e - b) AS n_removed, max(e) AS tail, flatten(list(before ORDER BY b)) AS kept FROM gaps GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN tail IS NULL THEN ws ELSE kept || ws[tail + 1 :] END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


_FIELDS = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))

# CRC-32 of a text of ASCII characters, bit by bit
_CRC = """xor(list_reduce(
  list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, b: list_reduce(range(8), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)), xor(c, b)), 4294967295
), 4294967295)"""

OP12 = f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents
),
hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS g,
    sha256({_FIELDS} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256({_FIELDS} || coalesce(strlen(changed) || ':' || changed, '-')) AS tampered
  FROM d
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
levels AS (
  SELECT g, 0 AS level, list(leaf ORDER BY i) AS nodes FROM numbered GROUP BY g
  UNION ALL
  SELECT g, level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda p: sha256(array_to_string(nodes[3 * p + 1 : 3 * p + 3], '')))
  FROM levels WHERE len(nodes) > 1
),
subroots AS (SELECT g, nodes[1] AS subroot, row_number() OVER (ORDER BY g) - 1 AS place FROM levels WHERE len(nodes) = 1),
upper AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda p: sha256(array_to_string(nodes[3 * p + 1 : 3 * p + 3], '')))
  FROM upper WHERE len(nodes) > 1
),
trees AS (
  SELECT g, level, nodes FROM levels WHERE len(nodes) > 1
  UNION ALL SELECT s.g, h.height + u.level, u.nodes
  FROM upper u, subroots s JOIN (SELECT g, max(level) AS height FROM levels GROUP BY g) h USING (g) WHERE len(u.nodes) > 1
),
climb AS (
  SELECT n.doc_id, n.g, n.leaf, n.i AS own, 0 AS level, n.i, h.height, s.place, n.tampered AS folded, '' AS proof
  FROM numbered n JOIN (SELECT g, max(level) AS height FROM levels GROUP BY g) h USING (g) JOIN subroots s USING (g)
  UNION ALL
  SELECT doc_id, g, leaf, own, level + 1, p, height, place, sha256(before || folded || after), proof || before || after
  FROM (
    SELECT c.*, c.spot // 3 AS p, CASE WHEN spot % 3 = 0 THEN '' ELSE array_to_string(t.nodes[3 * (spot // 3) + 1 : spot], '') END AS before,
      array_to_string(t.nodes[spot + 2 : 3 * (spot // 3) + 3], '') AS after
    FROM (SELECT *, CASE WHEN level = height THEN place ELSE i END AS spot FROM climb) c JOIN trees t ON t.g = c.g AND t.level = c.level
  )
),
ends AS (SELECT *, row_number() OVER (PARTITION BY g, own ORDER BY level DESC) AS back FROM climb)
SELECT e.doc_id, e.leaf, s.subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = r.root AS verified
FROM ends e JOIN subroots s USING (g), (SELECT nodes[1] AS root FROM upper WHERE len(nodes) = 1) r WHERE back = 1
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
shares AS (
  SELECT lang, source, term, c, 1 + (CAST(1000000000 AS HUGEINT) * (c + 2)) // (CAST(sum(c) OVER (PARTITION BY lang, source) AS HUGEINT) + 2 * v) AS p
  FROM grid JOIN sizes USING (lang)
),
whole AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 2)) // (CAST(sum(sum(c)) OVER (PARTITION BY lang) AS HUGEINT) + 2 * v) AS q
  FROM grid JOIN sizes USING (lang) GROUP BY lang, term, v
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": OP3, "op6_decontaminate": OP6, "op7_suffix_dedup": OP7, "op10_substring_dedup": OP10, "op12_merkle": OP12, "op13_source_divergence": OP13}
