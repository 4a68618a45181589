"""DuckDB SQL of the queries that SQL can express."""

_SPACE = r"[ \x09-\x0D]"
_WORDS = r"[^ \x09-\x0D]+"

OP9 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size,
         coalesce(text, '') AS t,
         (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 12))::BIGINT::DOUBLE + 1.0)
           / 281474976710656.0 AS u
  FROM documents),
w AS (
  SELECT *, 1.0::DOUBLE / pow(2.0, least(4, floor(
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g'))) * 20 / greatest(length(t), 1))::INT)) AS weight
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, 3 * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
         sum(w) OVER (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
  FROM s),
c AS (SELECT *, rem * w > cap * ws AS capped FROM f),
l AS (SELECT rem, ws FROM c WHERE NOT capped ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST LIMIT 1),
g AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (w * (SELECT rem FROM l))::DOUBLE / (SELECT ws FROM l)::DOUBLE END AS target
  FROM c),
p AS (
  SELECT w.doc_id, w.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS whole,
         coalesce(sum(w.size) OVER (PARTITION BY w.source ORDER BY -ln(u) / weight, w.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM w JOIN g ON w.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN size > 0 AND start + size / 2.0::DOUBLE <= target - whole * source_size
                     THEN 1 ELSE 0 END)::BIGINT * size AS taken
FROM p
"""

_CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"]


def _escaped_length(c: str) -> str:
    """Length of a text with a backslash before each control string, and before
    each backslash that another special character or the end follows."""
    controls = " + ".join(f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in _CONTROLS)
    runs = f"len(regexp_extract_all({c}, '\\\\+'))"
    doubled = f"(length({c}) - length(replace({c}, '\\', ''))) - {runs}"
    before_special = f"len(regexp_extract_all({c}, '\\\\+(?:[<\\[]|$)'))"
    return f"(length({c}) + ({controls}) + ({doubled}) + ({before_special}))"


OP1 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT *, {_escaped_length('text')} AS body, {_escaped_length('role')} AS name,
         CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 20 END AS tags
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                                  ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       sum(tags + body + CASE WHEN tags = 20 THEN name ELSE 0 END)::BIGINT AS formatted_chars,
       count(CASE WHEN body > length(text) THEN 1 END)::BIGINT AS escaped_turns
FROM s GROUP BY conv_id
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
"""

OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
g AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e)
    AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(node, reach) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id)::BIGINT AS n_links, c.component_id,
       v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id
"""

OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(
                            range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
k AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
t AS (SELECT rep, n, unnest(s) AS t FROM k),
l AS (
  SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.t = b.t AND a.rep <> b.rep
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r(node, reach) AS (
  SELECT rep, rep FROM k UNION SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT node, min(reach) AS first FROM r GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(c.first, s.doc_id) AS component_id
FROM s LEFT JOIN k ON k.s = s.s LEFT JOIN c ON c.node = k.rep
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
x AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM x),
m AS (SELECT g, min(doc_id) AS first_id FROM v GROUP BY g),
f AS (
  SELECT DISTINCT v.doc_id, unnest(range(v.i, v.i + 13)) AS p FROM v JOIN m USING (g) WHERE m.first_id < v.doc_id),
a AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
k AS (
  SELECT a.doc_id, count(f.p)::BIGINT AS n_removed,
         coalesce(string_agg(CASE WHEN f.p IS NULL THEN a.word END, ' ' ORDER BY a.p), '') AS kept
  FROM a LEFT JOIN f ON f.doc_id = a.doc_id AND f.p = a.p GROUP BY a.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (sum(coalesce(c.n, 0)) OVER w + 2 * count(*) OVER w) AS p
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  WINDOW w AS (PARTITION BY g.lang, g.source)),
l AS (
  SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS q
  FROM k WINDOW w AS (PARTITION BY lang)),
v AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, (((s.p - l.q) * (s.p - l.q)) // (s.p + l.q))::BIGINT
  FROM s JOIN l ON l.lang = s.lang AND l.term = s.term WHERE s.n > 0 AND s.p > l.q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM o QUALIFY part = 'pair' OR rank <= 10
"""
