"""DuckDB SQL of the queries of this package that SQL can express."""

from __future__ import annotations

from . import licenses, quality, sharding, urltree

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 4], ' ')) AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest(range(5)) AS k FROM grams WHERE c > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
), judged AS (
  SELECT doc_id, line, len(ws) AS n,
    100 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 20 * len(ws)
    OR length(regexp_replace(line, '[^|»›]', '', 'g')) >= 2
    OR len(ws) <= 3 AND len(list_filter(ws, lambda w: lower(w) NOT IN ('about', 'back', 'contact', 'cookies', 'faq', 'help', 'home',
      'imprint', 'login', 'logout', 'menu', 'next', 'previous', 'register', 'search', 'sitemap'))) = 0
    OR regexp_matches(line, '(?i)accept cookies|all rights reserved|click here to|cookie policy|enable javascript|lorem ipsum|privacy policy|read more\.\.\.|sign up for our newsletter|terms of service|terms of use')
    OR len(ws) >= 3 AND regexp_matches(line, '[A-Z]') AND NOT regexp_matches(line, '[a-zß-öø-ÿ]')
    OR len(ws) > 1 AND 100 * len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) > 50 * len(ws)
    OR NOT regexp_matches(line, '@MARKS@') AS fails
  FROM lines WHERE len(ws) > 0
), per_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
    coalesce(sum(n) FILTER (WHERE fails), 0)::BIGINT AS n_lost_words, count(*) FILTER (WHERE fails) AS n_failed_lines
  FROM judged GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lost_words, 0) AS n_lost_words, coalesce(n_failed_lines, 0) AS n_failed_lines
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN per_doc USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_lost_words <= 30 * n_words AS kept,
  n_lost_words, n_failed_lines
FROM m
""".replace("@MARKS@", f"[{quality.SENTENCE_MARKS}]")

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM wins),
seen AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes)
), hits AS (SELECT doc_id, s.n, i, item_id FROM seen s JOIN wins USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, i + unnest(range(n)) AS pos FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""



def _values(rows: list[tuple]) -> str:
    def literal(x: object) -> str:
        return "'" + str(x).replace("'", "''") + "'" if isinstance(x, str) else f"{x!r}::DOUBLE"

    return ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


def _descend(tree: list[sharding.Leaf], name: str) -> str:
    """CTEs that place each key in the tree level by level."""
    out, before = [], "SELECT DISTINCT k, '' AS node FROM rows"
    for i, level in enumerate(sharding.levels(tree)):
        out.append(f"""{name}{i} AS (
  SELECT k, arg_min(v.node, (-ln((('0x' || substr(md5(v.node || '/' || k), 1, 13))::BIGINT::DOUBLE + 1.0) / 4503599627370496.0) / v.w, v.node)) AS node
  FROM ({before}) u JOIN (VALUES {_values(level)}) v(parent, node, w) ON u.node = v.parent GROUP BY k
)""")
        before = f"SELECT k, node FROM {name}{i}"
    return ",\n".join(out)


OP2 = f"""
WITH rows AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes
  FROM documents
), sums AS (
  SELECT doc_id, k, size, xor(list_reduce(
      flatten(list_transform(bytes, lambda b: [('0x' || b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295::BIGINT
    ), 4294967295::BIGINT) AS text_crc32
  FROM rows
),
{_descend(sharding.even_tree(8), "now")},
{_descend(sharding.grown_tree(sharding.even_tree(8)), "later")},
placed AS (
  SELECT doc_id, size, text_crc32, split_part(n.node, '/', 3)::INT AS shard, split_part(l.node, '/', 3)::INT AS grown_shard,
    ('0x' || substr(md5('slot/' || s.k || '/' || text_crc32 || '/' || size), 1, 3))::INT AS bucket
  FROM sums s JOIN now2 n USING (k) JOIN later2 l USING (k)
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""


def _url_sql(s: urltree.Settings) -> str:
    n = s.depth + 1
    g, t = [f"g{i}" for i in range(1, n + 1)], [f"t{i}" for i in range(1, n + 1)]
    rule_cases = "".join(
        f" WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{r}'"
        for _, r in sorted(urltree.RULES, key=lambda r: (-len(r[1]), r[1]))
        for h, _, p in [r.partition("/")]
    )
    verdicts = "".join(f" WHEN '{r}' THEN '{v}'" for v, r in urltree.RULES)

    def form(x: str) -> str:
        hexa = "[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}|[0-9a-f]{{16,}}".replace("{{", "{").replace("}}", "}")
        return f"regexp_replace(regexp_replace({x}, '{hexa}', '{{h}}', 'g'), '[0-9]+', '{{n}}', 'g')"

    segs = [f"coalesce({form(f'parts[{i + 1}]')}, '') AS g{i}" for i in range(1, s.depth + 1)]
    segs.append(f"CASE WHEN len(parts) > {n} THEN {form(f'array_to_string(parts[{n + 1}:], chr(47))')} ELSE '' END AS g{n}")
    lower = urltree.LETTERS.lower()
    sql = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), hp AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{urltree.LETTERS}', '{lower}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), ruled AS (SELECT *, CASE{rule_cases} END AS rule, string_split(path, '/') AS parts FROM hp),
rows AS (SELECT page_id, host, path, rule, CASE rule{verdicts} END AS verdict, {", ".join(segs)} FROM ruled),
a0 AS (
  SELECT host, {", ".join(g)}, {", ".join(f"{x} AS {y}" for x, y in zip(g, t))}, count(*) AS n, count(verdict) AS labelled,
    count(*) FILTER (WHERE verdict = 'block') AS blocked FROM rows GROUP BY host, {", ".join(g)}
)"""
    for i, x in enumerate(t):
        node = ", ".join(["host", *t[:i]])
        sql += f""", w{i} AS (
  SELECT {node} FROM (SELECT {node}, {x}, sum(n) AS n FROM a{i} GROUP BY {node}, {x}) GROUP BY {node}
  HAVING count(*) >= {s.min_kinds} AND 100 * count(*) >= {s.kinds_pct} * sum(n)
), a{i + 1} AS (
  SELECT a{i}.* REPLACE (CASE WHEN wide AND {x} <> '' THEN '*' ELSE {x} END AS {x}) FROM a{i} LEFT JOIN (SELECT *, true AS wide FROM w{i}) USING ({node})
)"""
    sql = sql.replace("a0.* REPLACE", "* EXCLUDE (wide) REPLACE")
    for i in range(1, n):
        sql = sql.replace(f"a{i}.* REPLACE", "* EXCLUDE (wide) REPLACE")
    for i, x in enumerate(t):
        family = ", ".join(["host", *t[:i], *t[i + 1 :]])
        prev, new = f"a{n}" if i == 0 else f"m{i}", f"m{i + 1}"
        sql += f""", f{i} AS (
  SELECT {family}, {x}, sum(labelled) AS bl, sum(blocked) AS bb,
    CASE WHEN 2 * sum(blocked) >= sum(labelled) THEN '(+)' ELSE '(-)' END AS side FROM {prev} GROUP BY {family}, {x}
  HAVING sum(labelled) >= {s.min_labelled} AND {x} NOT IN ('', '*')
), l{i} AS (
  SELECT {family}, {x}, side AS alike FROM f{i} JOIN (
    SELECT {family}, side, sum(bl) AS pl, sum(bb) AS pb FROM f{i} GROUP BY {family}, side HAVING count(*) > 1) USING ({family}, side)
  WHERE abs(bb / bl - pb / pl) <= {s.z}::DOUBLE * sqrt(pb / pl * (1.0::DOUBLE - pb / pl) / bl)
), {new} AS (SELECT * EXCLUDE (alike) REPLACE (coalesce(alike, {x}) AS {x}) FROM {prev} LEFT JOIN l{i} USING ({family}, {x}))"""
    tt = ", ".join(t)
    down = ""
    for i in range(1, n + 1):  # each node leans on the one above it
        node, parent = ", ".join(["host", *t[:i]]), ", ".join(["host", *t[: i - 1]])
        down += f""", p{i + 1} AS (
  SELECT {node}, (sum(blocked) + {s.prior}::DOUBLE * any_value(purity)) / (sum(labelled) + {s.prior}::DOUBLE) AS purity
  FROM m{n} JOIN p{i} USING ({parent}) GROUP BY {node}
)"""
    return sql + f""", rate AS (
  SELECT coalesce(count(*) FILTER (WHERE verdict = 'block') / nullif(count(verdict), 0), 0.0)::DOUBLE AS rate FROM rows
), p0 AS (
  SELECT regexp_extract(host, '([^.]+[.])?[^.]*$') AS site, (sum(blocked) + {s.prior}::DOUBLE * any_value(rate)) / (sum(labelled) + {s.prior}::DOUBLE) AS purity
  FROM m{n}, rate GROUP BY ALL
), p1 AS (
  SELECT host, (sum(blocked) + {s.prior}::DOUBLE * any_value(purity)) / (sum(labelled) + {s.prior}::DOUBLE) AS purity
  FROM m{n} JOIN p0 ON regexp_extract(host, '([^.]+[.])?[^.]*$') = site GROUP BY host
){down}, judged AS (SELECT * FROM p{n + 1})
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN purity >= {s.purity}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
  rtrim({" || ".join(f"'/' || {x}" for x in t)}, '/') AS template, round(purity, 6) AS purity
FROM rows JOIN m{n} USING (host, {", ".join(g)}) JOIN judged USING (host, {tt})
"""


OP4 = _url_sql(urltree.Settings())

OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS s FROM (SELECT doc_id, h, unnest(range(n - 199)) AS p FROM d)),
dup AS (SELECT doc_id, p FROM w JOIN (SELECT s FROM w GROUP BY s HAVING count(*) > 1) USING (s)),
runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM (
    SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
      SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS new FROM dup)
  ) GROUP BY doc_id, run
), kept AS (
  SELECT doc_id, any_value(d.n) AS n, count(r.a) AS n_spans, coalesce(sum(r.b - r.a), 0)::BIGINT AS n_removed,
    coalesce(list(r.a ORDER BY r.a) FILTER (WHERE r.a IS NOT NULL), []) AS starts, coalesce(list(r.b ORDER BY r.a) FILTER (WHERE r.a IS NOT NULL), []) AS ends
  FROM d LEFT JOIN runs r USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, k.n AS n_bytes, n_removed, n_spans, sha256(unhex(array_to_string(list_transform(
    range(len(starts) + 1), lambda i: substr(h, 2 * (CASE WHEN i = 0 THEN 0 ELSE ends[i] END) + 1,
      2 * ((CASE WHEN i = len(starts) THEN k.n ELSE starts[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE ends[i] END)))), ''))) AS kept_sha256
FROM kept k JOIN d USING (doc_id)
"""


def _license_sql(least: float = 0.7, share: int = 50) -> str:
    weights, idf, unseen = licenses.template_weights(licenses.TEMPLATES)
    token = licenses.TOKEN
    return f"""
WITH f AS (
  SELECT doc_id, text, concat_ws('/', source, CASE WHEN lang <> 'en' THEN lang END, doc_id::VARCHAR || '.txt') AS path,
    len(regexp_extract_all(lower(text), '{token}')) AS n FROM documents
), lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM f),
kinds AS (SELECT DISTINCT line FROM lines),
tf AS (SELECT line, token, count(*) AS f FROM (SELECT line, unnest(regexp_extract_all(lower(line), '{token}')) AS token FROM kinds) GROUP BY ALL),
parts AS (SELECT line, tf.token, f * coalesce(i.idf, {unseen}::DOUBLE) AS x FROM tf LEFT JOIN (VALUES {_values(list(idf.items()))}) i(token, idf) USING (token)),
norms AS (SELECT line, sqrt(sum(x * x)) AS norm FROM parts GROUP BY line),
dots AS (
  SELECT line, license, sum(x * w) AS dot FROM parts JOIN (VALUES {_values([(t, n, w) for (n, t), w in weights.items()])}) v(token, license, w) USING (token)
  GROUP BY line, license
), near AS (SELECT line, license, round(dot / norm, 6) AS cosine FROM dots JOIN norms USING (line) WHERE round(dot / norm, 6) >= {least}::DOUBLE),
best AS (SELECT line, license, cosine FROM near QUALIFY row_number() OVER (PARTITION BY line ORDER BY cosine DESC, license) = 1),
own AS (
  SELECT doc_id, arg_min(license, (-cosine, license)) AS own_license, max(cosine) AS cosine,
    sum(len(regexp_extract_all(lower(line), '{token}'))) AS licensed FROM lines JOIN best USING (line) GROUP BY doc_id
), r AS (
  SELECT f.doc_id, path, own_license, cosine, coalesce(100 * licensed >= {share} * n, false) AS is_license_file,
    regexp_extract(path, '^(?:(.*)/)?[^/]*$', 1) AS dir FROM f LEFT JOIN own USING (doc_id)
), speaks AS (SELECT dir, own_license AS license, count(*) AS files FROM r WHERE is_license_file GROUP BY ALL),
of_dir AS (SELECT dir, license FROM speaks QUALIFY row_number() OVER (PARTITION BY dir ORDER BY files DESC, license) = 1),
up AS (
  SELECT d.dir, o.dir AS up_dir, o.license FROM (SELECT DISTINCT dir FROM r) d JOIN of_dir o ON d.dir = o.dir OR starts_with(d.dir, o.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(o.dir) DESC) = 1
)
SELECT doc_id, path, own_license, cosine, is_license_file, coalesce(own_license, license) AS license,
  CASE WHEN own_license IS NULL THEN up_dir END AS license_dir
FROM r LEFT JOIN up USING (dir)
"""


OP6 = _license_sql()

OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, least(doc_id, coalesce(min(y), doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON x = doc_id GROUP BY doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op2_sharding": OP2,
    "op3_decontamination": OP3,
    "op4_url_filter": OP4,
    "op5_suffix_array_dedup": OP5,
    "op6_license_scan": OP6,
    "op8_jaccard_join": OP8,
}
