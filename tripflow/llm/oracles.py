"""DuckDB twins of the registered queries."""

from tripflow.llm import line_quality as lq
from tripflow.llm import secrets, topk, url_graph

_W = r"[^\x20\x09-\x0D]+"


# Rounds of the twin; the query's end when ranks stand still, which the given tables reach long before.
_ROUNDS = 64


def _url_graph():
    order = sorted(url_graph.RULES, key=lambda r: -len(r[1]))
    fits = []
    for _, rule in order:
        name, start = rule.split("/", 1)
        fits.append(f"WHEN (host = '{name}' OR suffix(host, '.{name}')) AND prefix(path, '/{start}') THEN '{rule}'")
    ruled = " ".join(f"WHEN '{rule}' THEN '{verdict}'" for verdict, rule in order)
    a = url_graph.DAMPING
    rounds = "".join(
        f""", r{i} AS MATERIALIZED (SELECT kind, host, sum(rank) AS rank FROM (
            SELECT e.kind, e.dst AS host, {a} * r.rank * e.share AS rank FROM edges e JOIN r{i - 1} r
              ON e.kind = r.kind AND e.src = r.host
            UNION ALL SELECT kind, host, {1 - a} * rank FROM r0) GROUP BY 1, 2)"""
        for i in range(1, _ROUNDS + 1)
    )
    link = r"""<a\s[^>]*?href\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]*)"""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH cut AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, html, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    rules AS (SELECT *, CASE {' '.join(fits)} END AS rule FROM split),
    judged AS MATERIALIZED (SELECT *, CASE rule {ruled} END AS ruled FROM rules),
    hosts AS (SELECT host, count(*) AS n, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
              FROM judged WHERE host <> '' GROUP BY 1),
    shares AS (SELECT 'trust' AS kind, host, a / n AS share FROM hosts WHERE a > 0
               UNION ALL SELECT 'distrust', host, b / n FROM hosts WHERE b > 0),
    named AS (SELECT DISTINCT page_id, html, host AS src, {lower.format("regexp_extract(link, '^[^/]*//([^/?#]*)', 1)")} AS dst
              FROM (SELECT *, unnest(regexp_extract_all(html, '{link}', 1, 'i')) AS link FROM judged)),
    links AS (SELECT src, dst, count(*) AS pages FROM named WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
    ways AS (SELECT 'trust' AS kind, src, dst, pages FROM links UNION ALL SELECT 'distrust', dst, src, pages FROM links),
    edges AS MATERIALIZED (SELECT kind, src, dst, pages / sum(pages) OVER (PARTITION BY kind, src) AS share FROM ways),
    r0 AS MATERIALIZED (SELECT kind, host, share / sum(share) OVER (PARTITION BY kind) AS rank FROM shares)
    {rounds},
    marks AS (SELECT host, coalesce(sum(rank) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(rank) FILTER (kind = 'distrust'), 0) AS d
              FROM r{_ROUNDS} GROUP BY 1)
    SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN d >= {url_graph.LIMIT} * (t + d) THEN 'block' END, 'allow') AS verdict
    FROM judged j LEFT JOIN marks m ON j.host = m.host"""


def _secret_scan():
    """Windows are counted from scratch here, and marked windows are merged by gaps in their starts."""
    kinds = [
        (0, secrets._ASSIGN + secrets._VALUE), (1, secrets._ACCESS), (2, secrets._HEX),
    ]
    for kind_no, alphabet, window, _ in secrets.CLASSES:
        kinds.append((kind_no, f"[{alphabet.replace('-', '')}{'-' if '-' in alphabet else ''}]{{{window},}}"))
    bare = "coalesce(text, '')"
    for piece in secrets.ALLOWED_PIECES:
        bare = f"regexp_replace({bare}, '{piece}', '{' ' * len(piece)}', 'gi')"
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS kind_no, unnest(regexp_extract_all(whole, '{p.replace("'", "''")}')) AS hit,
            unnest(list_transform(generate_series(1, len(regexp_extract_all(whole, '{p.replace("'", "''")}'))), lambda i: i)) AS i,
            string_split_regex(whole, '{p.replace("'", "''")}') AS gaps,
            regexp_extract_all(whole, '{p.replace("'", "''")}') AS hits FROM (SELECT doc_id, {'whole' if k < 3 else 'bare'} AS whole FROM texts)"""
        for k, p in kinds
    )
    value = f"regexp_extract(hit, '^{secrets._ASSIGN}{secrets._VALUE}$'".replace("[\"']", "[\"'']") + ", 1)"
    classes = " UNION ALL ".join(
        f"SELECT {k} AS kind_no, {w} AS w, {secrets.weight_limit(w, b)} AS most, {secrets.weights(w)} AS weights"
        for k, _, w, b in secrets.CLASSES
    )
    allowed = " OR ".join(
        f"regexp_matches(hit, '{p}')"
        for p in secrets.ALLOWED
    )
    names = list(secrets.KINDS)
    text = "string_agg({names}[kind_no + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind_no, e)".replace("{names}", str(names))
    return f"""
    WITH texts AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS whole, {bare} AS bare FROM documents),
    found AS ({found}),
    placed AS (SELECT doc_id, kind_no, hit, CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
               + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS BIGINT) AS s FROM found),
    base AS MATERIALIZED (SELECT doc_id, kind_no, s, s + length(hit) AS e FROM placed
             WHERE kind_no IN (1, 2) OR (kind_no = 0 AND length({value}) >= {secrets.VALUE_CHARS})),
    classes AS ({classes}),
    runs AS (SELECT doc_id, kind_no, hit, s, w, most, weights, row_number() OVER () AS run FROM placed JOIN classes USING (kind_no) WHERE NOT ({allowed})),
    windows AS (SELECT *, substr(hit, CAST(p AS BIGINT), w) AS win FROM (SELECT *, unnest(generate_series(1, length(hit) - w + 1)) AS p FROM runs)),
    chars AS (SELECT run, p, count(*) AS c FROM (SELECT run, p, unnest(string_split(win, '')) AS ch FROM windows) GROUP BY run, p, ch),
    sums AS (SELECT run, p, sum(weights[c + 1]) AS total FROM chars JOIN (SELECT DISTINCT run, weights FROM runs) USING (run) GROUP BY 1, 2),
    marked AS (SELECT doc_id, kind_no, run, s + p - 1 AS s, w FROM windows JOIN sums USING (run, p) WHERE total <= most),
    fresh AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY run ORDER BY s) <= w THEN 0 ELSE 1 END AS head FROM marked),
    grouped AS (SELECT *, sum(head) OVER (PARTITION BY run ORDER BY s) AS g FROM fresh),
    entropy AS (SELECT doc_id, kind_no, min(s) AS s, max(s + w) AS e FROM grouped GROUP BY doc_id, kind_no, run, g),
    added AS (SELECT * FROM entropy n
              WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = n.doc_id AND b.s <= n.s AND n.e <= b.e)
                AND NOT EXISTS (SELECT 1 FROM entropy o WHERE o.doc_id = n.doc_id AND o.kind_no < n.kind_no AND o.s <= n.s AND n.e <= o.e)),
    told AS (SELECT doc_id, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access,
               count(*) FILTER (kind_no = 2) AS n_hex, {text} AS spans FROM base GROUP BY 1),
    told_all AS (SELECT doc_id, {text} AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY 1)
    SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(a.spans, '') AS spans
    FROM texts t LEFT JOIN told b USING (doc_id) LEFT JOIN told_all a USING (doc_id)"""


_LINE_QUALITY = rf"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS host, text, coalesce(text, '') AS whole FROM documents),
ws AS (SELECT doc_id, regexp_extract_all(whole, '{_W}') AS w FROM texts),
grams AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM ws WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, i + k AS p FROM twice, (VALUES (0), (1), (2)) t(k)) GROUP BY 1),
lines AS (SELECT doc_id, host, md5(text) AS fp, line FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM texts)
          WHERE regexp_matches(line, '{_W}')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY 1),
norm AS (SELECT doc_id, host, fp, lower(trim(regexp_replace(line, '[\x20\x09-\x0D0-9]+', ' ', 'g'))) AS line,
           len(regexp_extract_all(line, '{_W}')) AS n FROM lines),
entries AS (SELECT DISTINCT host, fp, line FROM norm),
keys AS (SELECT host, fp, min(spark_hash) AS key FROM (SELECT host, fp, md5(line) AS spark_hash FROM entries) GROUP BY 1, 2),
hosts AS (SELECT host, count(DISTINCT md5(text)) AS host_docs FROM texts WHERE text IS NOT NULL GROUP BY 1),
often AS (SELECT host, line FROM entries JOIN keys USING (host, fp) JOIN hosts USING (host) GROUP BY host, line, host_docs
          HAVING count(*) >= {lq.MIN_DOCS} AND count(DISTINCT key) >= {lq.MIN_VARIETY} * count(*) AND count(*) >= {lq.MIN_SHARE} * host_docs),
removed AS (SELECT doc_id, sum(n) AS n_removed FROM norm JOIN often USING (host, line) GROUP BY 1),
judged AS (SELECT t.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(whole) - length(regexp_replace(whole, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed, 0) AS n_removed
  FROM texts t JOIN ws USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id))
SELECT * EXCLUDE (n_removed), n_words < {lq.MIN_WORDS} OR 100 * n_repeat_words > {lq.REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {lq.MIN_WORDS} OR 100 * n_repeat_words > {lq.REPEAT_PERCENT} * n_words)
  AND n_words - n_removed >= {lq.LEAST_LEFT} * n_words AS kept FROM judged"""

_TOP_PRODUCTS = f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % {topk.QUERY_STRIDE} = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= {topk.TOP}"""

_JACCARD = rf"""
WITH RECURSIVE ws AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM ws WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM ws WHERE len(w) BETWEEN 1 AND 4)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
links AS MATERIALIZED (SELECT x.a, x.b FROM (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS n_both FROM sh s JOIN sh t USING (g)
    WHERE s.doc_id <> t.doc_id GROUP BY 1, 2) x JOIN sizes p ON p.doc_id = x.a JOIN sizes q ON q.doc_id = x.b
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""

ORACLES = {
    "op1_url_graph": _url_graph(),
    "op2_secret_scan": _secret_scan(),
    "op3_line_quality": _LINE_QUALITY,
    "op6_top_products": _TOP_PRODUCTS,
    "op7_jaccard_join": _JACCARD,
}
