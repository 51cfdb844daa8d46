"""SQL of other engines for the queries that it can express."""

from __future__ import annotations

import string

#: CRC-32 of a decimal number's text: the table of bytes by its rule, then a fold over the bytes.
_CRC_TABLE = "crc0 AS (SELECT i, 0 AS k, i AS c FROM range(256) AS r(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc0 WHERE k < 8), crc AS (SELECT list(c ORDER BY i) AS t FROM crc0 WHERE k = 8)"


def _crc32(number: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT)"


OP4_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
links AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, links.b FROM r JOIN links ON links.a = r.b)
SELECT doc_id, n AS n_shingles, m AS component_id, doc_id = m AS kept FROM n JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) ON a = doc_id"""

OP9_SQL = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT s, min(doc_id) AS m FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)) USING (s) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS k FROM hit, range(0, 50) AS r(o)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

#: A line goes if it lies in a run of lines with ten words or more that an earlier document has; the shortest runs from and up to a line are enough.
OP10_SQL = r"""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM documents),
s AS (SELECT doc_id, list_transform(x, lambda y: regexp_replace(y, '^[\x20\x09\x0B\x0C\x0D]+|[\x20\x09\x0B\x0C\x0D]+$', '', 'g')) AS y FROM d WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(1, len(y) + 1)) AS k, unnest(list_transform(y, lambda z: len(regexp_extract_all(z, '[^\x20\x09-\x0D]+')))) AS n FROM s),
u AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS up FROM l),
b AS (SELECT a.doc_id, a.k AS lo, min(z.k) AS hi FROM u a JOIN u z ON z.doc_id = a.doc_id AND z.k >= a.k AND z.up >= a.up - a.n + 10 WHERE a.n > 0 GROUP BY a.doc_id, a.k
  UNION SELECT z.doc_id, max(a.k), z.k FROM u z JOIN u a ON z.doc_id = a.doc_id AND z.k >= a.k AND z.up >= a.up - a.n + 10 WHERE z.n > 0 GROUP BY z.doc_id, z.k),
t AS (SELECT doc_id, lo, hi, array_to_string(y[lo:hi], chr(10)) AS block FROM b JOIN s USING (doc_id)),
f AS (SELECT block, min(doc_id) AS m FROM t GROUP BY block HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, list_distinct(flatten(list(range(lo, hi + 1)))) AS gone FROM t JOIN f USING (block) WHERE doc_id > m GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(x), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed_lines,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN x ELSE list_filter(x, lambda y, i: NOT list_contains(gone, i)) END, chr(10)), '')) AS kept_sha256 FROM d LEFT JOIN g USING (doc_id)"""

OP11_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(t) AS payload_digest, CASE WHEN n >= 100 AND m < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND m < page_id THEN m END AS refers_to FROM p"""

OP12_SQL = f"""WITH RECURSIVE {_CRC_TABLE},
turns AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
head AS (SELECT conv_id, own, {_crc32("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS base FROM turns, crc),
path AS (SELECT c.conv_id, list_concat(coalesce(b.own[1:h], []), c.own[h + 1:]) AS p FROM head c LEFT JOIN turns b ON b.conv_id = c.base),
member AS (SELECT conv_id, d, p[1:d] AS k, len(p) = d AS ended FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM path)),
node AS (SELECT d, k, min(conv_id) AS c, count(*) AS n, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends FROM member GROUP BY d, k),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1, 2),
own AS (SELECT node.*, coalesce(kids, 0) AS kids, CASE WHEN d > 0 THEN (n - 1) * length(k[d].t) ELSE 0 END AS saves FROM node LEFT JOIN kids USING (d, k)),
below AS (SELECT a AS d, k[1:a] AS k, count(*) FILTER (kids = 0) AS leaves, sum(saves) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) GROUP BY 1, 2)
SELECT o.c AS conv_id, o.d AS depth, p.c AS parent_conv_id, o.n AS n_convs, o.kids AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, o.ends AS ends_sha256
FROM own o JOIN below b ON b.d = o.d AND b.k = o.k LEFT JOIN node p ON p.d = o.d - 1 AND p.k = o.k[1:o.d - 1]"""


def _manifest(levels: int = 5, tops: int = 4) -> str:
    """Levels that leave one node as it is, so that more of them than are needed change nothing: enough for 16 ** levels documents of a source and 16 ** tops sources."""
    shown = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(map(shown, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    ctes = [
        _CRC_TABLE,
        f"doc AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc32('coalesce(doc_id, 0)')} % 5 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS x0 FROM documents, crc)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM doc)",
        "a0 AS (SELECT source, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves)",
    ]
    run = "OVER (PARTITION BY {0} i // 16 ORDER BY i ROWS BETWEEN {1})"

    def level(name: str, to: str, key: str) -> None:
        keys = f"{key}, " if key else ""
        around = lambda w: f"CASE WHEN n > 1 THEN coalesce(string_agg(h, '') {run.format(keys, w)}, '') ELSE '' END"
        ctes.append(f"{name}s AS (SELECT {keys}i, n, {around('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS b, {around('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS e FROM {name})")
        ctes.append(f"{to}u AS (SELECT {keys}i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {name} GROUP BY {keys}i // 16)")
        ctes.append(f"{to} AS (SELECT *, count(*) OVER ({f'PARTITION BY {key}' if key else ''}) AS n FROM {to}u)")

    for k in range(levels):
        level(f"a{k}", f"a{k + 1}", "source")
    ctes.append(f"t0 AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n FROM a{levels})")
    for k in range(tops):
        level(f"t{k}", f"t{k + 1}", "")
    steps, at = [], "leaves"
    for kind, n in (("a", levels), ("t", tops)):
        for k in range(n):
            here, to = f"{kind}{k}s", f"f{len(steps)}"
            on = f"f.source IS NOT DISTINCT FROM s.source AND s.i = f.i // {16**k}" if kind == "a" else f"s.i = f.top // {16**k}"
            rest = "*, '' AS proof" if not steps else "*"
            own = f"(SELECT {rest} FROM {at})"
            if kind == "t" and k == 0:
                own = f"(SELECT q.*, t0.i AS top, t0.h AS subroot FROM {at} q JOIN t0 ON t0.source IS NOT DISTINCT FROM q.source)"
            ctes.append(f"{to} AS (SELECT f.* EXCLUDE (x0, proof), CASE WHEN s.n > 1 THEN sha256(s.b || x0 || s.e) ELSE x0 END AS x0, proof || s.b || s.e AS proof FROM {own} f JOIN {here} s ON {on})")
            steps.append(to)
            at = to
    return f"WITH RECURSIVE {', '.join(ctes)} SELECT doc_id, leaf, subroot, t{tops}.h AS root, sha256(proof) AS proof_sha256, x0 AS folded_root, x0 = t{tops}.h AS verified FROM {at}, t{tops}"


OP13_SQL = _manifest()
