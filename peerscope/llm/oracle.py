"""DuckDB statements of the operators' queries that SQL can express."""

SQL: dict[str, str] = {
    "op1_url_rules": """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(h, p, v)
), fits AS (
  SELECT host, path, h || p AS rule, v, row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (host, path)
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
}


def _enc(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_enc(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _crc(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _levels(name: str, start: str) -> str:
    """A recursive table (g, lvl, i, n, h): the nodes of every level above those of ``start``."""
    return f"""{name} AS ({start} UNION ALL
  SELECT g, lvl + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(b, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY g ORDER BY i) AS b FROM {name} WHERE n > 1) WHERE i % 2 = 0)"""


SQL["op12_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf('n_chars')} AS h,
         CASE WHEN n_chars IS NOT NULL AND {_crc('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS shown
  FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{_levels('tree', 'SELECT g, 0 AS lvl, i, n, h FROM ranked')},
subroots AS (SELECT g, h AS subroot, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS j, count(*) OVER () AS m FROM tree WHERE n = 1),
{_levels('top', "SELECT '' AS g, 0 AS lvl, j AS i, m AS n, subroot AS h FROM subroots")},
root AS (SELECT h AS root, lvl AS top_height FROM top WHERE n = 1),
steps AS (
  SELECT g, lvl, i, h FROM tree WHERE n > 1
  UNION ALL SELECT s.g, s.height + t.lvl, t.i, t.h FROM top t, subroots s WHERE t.n > 1),
places AS (
  SELECT r.g, r.i AS leaf_i, k.lvl, CASE WHEN k.lvl < s.height THEN r.i >> k.lvl ELSE s.j >> (k.lvl - s.height) END AS i
  FROM ranked r JOIN subroots s ON r.g = s.g, root, (SELECT unnest(range(0, 64)) AS lvl) k WHERE k.lvl < s.height + root.top_height),
siblings AS (SELECT p.g, p.leaf_i, p.lvl, p.i, s.h AS sibling FROM places p LEFT JOIN steps s ON s.g = p.g AND s.lvl = p.lvl AND s.i = xor(p.i, 1)),
proofs AS (SELECT g, leaf_i, sha256(coalesce(string_agg(sibling, '' ORDER BY lvl), '')) AS proof_sha256 FROM siblings GROUP BY g, leaf_i),
folded(g, leaf_i, lvl, h) AS (
  SELECT g, i, CAST(0 AS BIGINT), shown FROM ranked
  UNION ALL SELECT f.g, f.leaf_i, f.lvl + 1, CASE WHEN s.i % 2 = 0 THEN sha256(f.h || coalesce(s.sibling, '')) ELSE sha256(s.sibling || f.h) END
  FROM folded f JOIN siblings s ON s.g = f.g AND s.leaf_i = f.leaf_i AND s.lvl = f.lvl),
ends AS (SELECT g, leaf_i, arg_max(h, lvl) AS folded_root FROM folded GROUP BY g, leaf_i)
SELECT r.doc_id, r.h AS leaf, s.subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = root.root AS verified
FROM ranked r JOIN subroots s ON r.g = s.g JOIN ends e ON e.g = r.g AND e.leaf_i = r.i LEFT JOIN proofs p ON p.g = r.g AND p.leaf_i = r.i, root"""

_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_INSERT = ["('n','n',0,'','')", "('n','u',5,'I','\nuser:')", "('n','a',10,'II','\nuser:\nassistant:')", "('s','s',0,'','')", "('s','u',5,'I','\nuser:')", "('s','a',10,'II','\nuser:\nassistant:')"]
_INSERT += ["('u','u',0,'','')", "('u','a',5,'I','\nassistant:')", "('a','a',0,'','')", "('a','u',5,'I','\nuser:')"]
_MOVES = [f"('{q}','{q}','D','',2)" for q in "nsua"] + [f"('{p}','{q}','R','',1)" for p, q in ("nu", "su", "au", "ua")]
_MOVES += [f"('{p}','{q}','K','{i}',0)" for p, q, i in ("nss", "nuu", "suu", "auu", "uaa")]
# row by row: the least (cost, audit) for each state of the role pattern, with the rows made so far
SQL["op11_repair"] = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, c
  FROM raw JOIN (VALUES (0), (1)) v(c) ON kind <> 0 AND (c = 0 OR kind = 3)),
placed AS (
  SELECT *, left(role, 1) AS ini, rtrim(text, {_BLANKS}) AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), c) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, c) AS seen
  FROM damaged),
marked AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
ins(p, q, c, a, m) AS (VALUES {", ".join(_INSERT)}),
moves(p, q, e, ini, c) AS (VALUES {", ".join(_MOVES)}),
cells(conv_id, pos, q, cost, audit, made) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 'n', 0, '', '' FROM marked
  UNION ALL
  SELECT conv_id, pos, q, cost, audit, made FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS best FROM (
      SELECT s.conv_id, s.pos + 1 AS pos, v.q, s.cost + i.c + v.c + CASE WHEN v.e <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost, s.audit || i.a || v.e AS audit,
             s.made || i.m || CASE v.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
               ELSE chr(10) || CASE v.q WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text END AS made
      FROM cells s JOIN marked f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.pos = s.pos + 1 JOIN ins i ON i.p = s.q
      JOIN moves v ON v.p = i.q AND (v.e = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (v.e = 'R' OR v.ini = f.ini)))) WHERE best = 1),
facts AS (
  SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pos > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
ended AS (
  SELECT c.conv_id, c.cost + i.c AS cost, c.audit || i.a AS audit, c.made || i.m AS made,
         row_number() OVER (PARTITION BY c.conv_id ORDER BY c.cost + i.c, c.audit || i.a) AS best
  FROM cells c JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.n = c.pos JOIN ins i ON i.p = c.q AND i.q IN ('n', 'a'))
SELECT o.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
       coalesce(f.illegal, 0) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost, coalesce(e.audit, '') AS audit, sha256(coalesce(substr(e.made, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.best = 1"""
