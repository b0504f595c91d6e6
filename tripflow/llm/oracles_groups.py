"""DuckDB twins of the license, spelling and conversation queries."""

from tripflow.llm import licenses, prefix_trie, spelling

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc_table():
    """The 256 remainders of the CRC-32 polynomial, by its rule."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


def _crc32(text):
    """CRC-32 of a text's UTF-8 bytes in SQL; ``crc_table`` must be in scope as a list ``t``."""
    data = (
        f"list_transform(range(0, octet_length(encode({text}))::BIGINT), "
        f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    )
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), {step}), 4294967295::BIGINT)"


def _license_join():
    half, size = licenses.BLOCK // 2, licenses.BLOCK
    templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
    phrases = ", ".join(f"('{text}', '{label}')" for text, label in licenses.PHRASES)
    fold = _FOLD.format("coalesce(text, '')")
    return rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({fold}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pairs AS MATERIALIZED (SELECT doc_id, i - 1 AS place, w[i] AS a, w[i + 1] AS b
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM docs WHERE len(w) > 1)),
phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {phrases}) v(p, label)),
places AS (SELECT DISTINCT doc_id, place, label FROM pairs JOIN phrases ON a = p[1] AND b = p[2] JOIN docs USING (doc_id)
  WHERE w[place + 1:place + len(p)] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
  list(DISTINCT label) AS base FROM places GROUP BY 1),
templates AS (SELECT i AS template, label, string_split(t, ' ') AS w FROM (VALUES {templates}) v(i, label, t)),
wanted AS MATERIALIZED (SELECT DISTINCT template, label, w[k] AS a, w[k + 1] AS b
  FROM (SELECT *, unnest(generate_series(1, len(w) - 1)) AS k FROM templates)),
sizes AS (SELECT template, count(*) AS n FROM wanted GROUP BY 1),
blocks AS (SELECT doc_id, block, template, label, count(DISTINCT (a, b)) AS common FROM (
    SELECT doc_id, place, a, b, unnest([place // {half}, place // {half} - 1]) AS block FROM pairs) JOIN wanted USING (a, b)
  WHERE block >= 0 AND place + 1 < block * {half} + {size} GROUP BY 1, 2, 3, 4),
found AS (SELECT doc_id, list(DISTINCT label) AS found, max(common / n) AS share FROM blocks JOIN sizes USING (template)
  WHERE 100 * common >= {licenses.CONTAINS} * n GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ',') AS labels,
  greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


def _spelling():
    run = "doc_id::VARCHAR || ':' || run"
    return rf"""
WITH RECURSIVE crc_table AS (SELECT {_crc_table()}::BIGINT[] AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all({_FOLD.format('text')}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.SHORTEST} GROUP BY 1, 2),
hashed AS MATERIALIZED (SELECT run, n, {_crc32(run)} AS h FROM runs, crc_table),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (
  SELECT n, CASE WHEN h % {spelling.DROP_EVERY} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {spelling.SHORTEST} GROUP BY 1 HAVING sum(n) >= {spelling.LEAST_COUNT}),
cuts AS MATERIALIZED (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS p FROM words)),
near AS MATERIALIZED (
  SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT word, rest FROM cuts WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM cuts WHERE rest IN (SELECT word FROM words)),
best AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n
  FROM near JOIN words ON b = word GROUP BY 1),
judged AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near,
  CASE WHEN form_n >= {spelling.TIMES} * n THEN form END AS form,
  CASE WHEN form_n >= {spelling.TIMES} * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS place FROM judged UNION SELECT w.word, j.form FROM walk w JOIN judged j ON j.word = w.place
  WHERE j.form IS NOT NULL)
SELECT j.word, n, j.form, place AS root, n_near, form_n FROM judged j
JOIN (SELECT word, place FROM walk WHERE place NOT IN (SELECT word FROM judged WHERE form IS NOT NULL)) USING (word)"""


def _prefix_trie():
    h = f"{_crc32('c::VARCHAR')} % {prefix_trie.HEAD_TURNS}"
    return rf"""
WITH crc_table AS (SELECT {_crc_table()}::BIGINT[] AS t),
own AS MATERIALIZED (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
  ORDER BY turn NULLS FIRST, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
heads AS MATERIALIZED (SELECT c, turns, {h} AS h FROM own, crc_table),
rebuilt AS MATERIALIZED (SELECT o.c, list_concat(coalesce(b.turns[:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM heads o LEFT JOIN own b ON b.c = o.c - o.c % {prefix_trie.FAMILY}),
paths AS MATERIALIZED (SELECT c, d, len(turns) AS size, sha256(turns[:d]::VARCHAR) AS node, turns[d].t AS last,
    CASE WHEN d > 0 THEN sha256(turns[:d - 1]::VARCHAR) END AS up
  FROM (SELECT c, turns, unnest(generate_series(0, len(turns))) AS d FROM rebuilt)),
nodes AS MATERIALIZED (SELECT d, node, min(c) AS owner, count(*) AS n_convs, any_value(up) AS up,
    (count(*) - 1) * coalesce(octet_length(encode(any_value(last))), 0) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends_sha256
  FROM paths GROUP BY 1, 2),
children AS MATERIALIZED (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
below AS (SELECT p.d, p.node, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.node = n.node JOIN paths p ON p.c = n.owner AND p.d <= n.d GROUP BY 1, 2)
SELECT n.owner AS conv_id, n.d AS depth, p.owner AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.node = n.node
LEFT JOIN children k ON k.d = n.d AND k.node = n.node LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.up"""


ORACLES = {
    "op11_license_join": _license_join(),
    "op12_spelling_variants": _spelling(),
    "op13_prefix_trie": _prefix_trie(),
}
