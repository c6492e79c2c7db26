"""SQL that gives the rows of corpus queries over the same tables."""

from __future__ import annotations

#: A list of the 256 remainders, and the checksum of a text by it.
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b)
    FROM range(256) r(b))"""


def _crc32(text: str, table: str) -> str:
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substring({text}, i, 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, x: xor(c >> 8, {table}[(xor(c, x) & 255) + 1])), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MERKLE_MANIFEST = f"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
docs AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR", "t")} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claimed
  FROM documents, tab),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS total FROM docs),
inner_nodes AS (
  SELECT tree, 0 AS level, place, total, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, (any_value(total) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM inner_nodes WHERE total > 1 GROUP BY tree, level, place // 2),
inside AS MATERIALIZED (SELECT * FROM inner_nodes),
subroots AS MATERIALIZED (
  SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS total
  FROM inside WHERE total = 1),
outer_nodes AS (
  SELECT 0 AS level, place, total, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (any_value(total) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM outer_nodes WHERE total > 1 GROUP BY level, place // 2),
outside AS MATERIALIZED (SELECT * FROM outer_nodes),
steps AS MATERIALIZED (
  SELECT p.tree, p.place, 0 AS part, n.level, xor((p.place >> n.level), 1) AS other,
    ((p.place >> n.level) & 1) = 1 AS on_left, s.digest AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, level, total FROM inside WHERE total > 1) n ON n.tree = p.tree
  LEFT JOIN inside s ON s.tree = p.tree AND s.level = n.level AND s.place = xor((p.place >> n.level), 1)
  UNION ALL
  SELECT p.tree, p.place, 1, n.level, xor((r.place >> n.level), 1), ((r.place >> n.level) & 1) = 1, s.digest
  FROM placed p JOIN subroots r ON r.tree = p.tree CROSS JOIN (SELECT DISTINCT level FROM outside WHERE total > 1) n
  LEFT JOIN outside s ON s.level = n.level AND s.place = xor((r.place >> n.level), 1)),
proofs AS MATERIALIZED (
  SELECT tree, place, list({{'on_left': on_left, 'sibling': sibling}} ORDER BY part, level) AS path,
    coalesce(string_agg(sibling, '' ORDER BY part, level), '') AS joined
  FROM steps GROUP BY tree, place),
folds AS (
  SELECT p.tree, p.place, 0 AS done, p.claimed AS digest, f.path, coalesce(len(f.path), 0) AS n
  FROM placed p LEFT JOIN proofs f ON f.tree = p.tree AND f.place = p.place
  UNION ALL
  SELECT tree, place, done + 1,
    sha256(CASE WHEN path[done + 1].sibling IS NULL THEN digest WHEN path[done + 1].on_left THEN path[done + 1].sibling || digest
           ELSE digest || path[done + 1].sibling END), path, n
  FROM folds WHERE done < n)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(f.joined, '')) AS proof_sha256,
  g.digest AS folded_root, g.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree CROSS JOIN (SELECT digest FROM outside WHERE total = 1) r
LEFT JOIN proofs f ON f.tree = p.tree AND f.place = p.place
JOIN folds g ON g.tree = p.tree AND g.place = p.place AND g.done = g.n
"""

_TRIMMED = "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_DELETE = "v{s} + 3"
_BIG = 1000000000000


def _raw(state: int) -> str:
    """Least cost of this turn's own edits from a state (0 nothing, 1 behind system, 2 behind user, 3 behind assistant)."""
    next_ = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    letter = "a" if next_ == 3 else "u"
    keep = [f"CASE WHEN initial = '{letter}' THEN cut + v{next_} ELSE {_BIG} END"]
    if state == 0:
        keep.append(f"CASE WHEN initial = 's' THEN cut + v1 ELSE {_BIG} END")
    return f"least(v{state} + 3, CASE WHEN fault IN (1, 2) THEN {_BIG} ELSE least(2 + cut + v{next_}, {', '.join(keep)}) END)"


TURN_REPAIR = f"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
ways AS MATERIALIZED (SELECT keyed.*, {_crc32("k", "t")} % 20 AS way FROM keyed, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN way = 1 THEN '' WHEN way = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN way = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM ways WHERE way <> 0),
placed AS MATERIALIZED (
  SELECT coalesce('=' || conv_id, '') AS conv, turn, role, text, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, left(role, 1) AS initial
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text), copy)),
faults AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN again > 1 THEN 2
    WHEN right({_TRIMMED}, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM placed),
turns AS MATERIALIZED (SELECT *, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS cut FROM faults),
back AS (
  SELECT conv, n AS i, 0 AS v0, 4 AS v1, 2 AS v2, 0 AS v3 FROM (SELECT DISTINCT conv, n FROM turns)
  UNION ALL
  SELECT conv, i, least(r0, 2 + r2, 4 + r3), least(r1, 2 + r2, 4 + r3), least(r2, 2 + r3), least(r3, 2 + r2)
  FROM (SELECT b.conv, b.i - 1 AS i, {", ".join(f"{_raw(s)} AS r{s}" for s in range(4))}
        FROM back b JOIN turns t ON t.conv = b.conv AND t.i = b.i WHERE b.i > 0)),
costs AS MATERIALIZED (SELECT conv, i, [v0, v1, v2, v3] AS v FROM back),
ahead AS MATERIALIZED (
  SELECT c.conv, c.i, c.v, d.v AS w, t.fault, t.cut, t.initial, t.role, t.text
  FROM costs c LEFT JOIN costs d ON d.conv = c.conv AND d.i = c.i + 1 LEFT JOIN turns t ON t.conv = c.conv AND t.i = c.i + 1),
walk AS (
  SELECT conv, i, 0 AS s, '' AS audit, []::VARCHAR[] AS lines FROM costs WHERE i = 0
  UNION ALL
  SELECT conv, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
    CASE WHEN e = 'D' THEN s WHEN e = 'K' AND initial = 's' THEN 1 ELSE nxt END, audit || e,
    CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      WHEN 'R' THEN list_append(lines, r || ':' || text) ELSE list_append(lines, r || ':') END
  FROM (SELECT *, CASE WHEN w IS NOT NULL AND v[s + 1] = 3 + w[s + 1] THEN 'D' WHEN v[s + 1] = 2 + v[nxt + 1] THEN 'I'
          WHEN fault IN (0, 3) AND (initial = left(r, 1) AND v[s + 1] = cut + w[nxt + 1] OR s = 0 AND initial = 's' AND v[1] = cut + w[2])
          THEN 'K' ELSE 'R' END AS e
        FROM (SELECT k.conv, k.i, k.s, k.audit, k.lines, a.v, a.w, a.fault, a.cut, a.initial, a.role, a.text,
                CASE WHEN k.s = 2 THEN 3 ELSE 2 END AS nxt, CASE WHEN k.s = 2 THEN 'assistant' ELSE 'user' END AS r
              FROM walk k JOIN ahead a ON a.conv = k.conv AND a.i = k.i
              WHERE a.w IS NOT NULL OR a.v[k.s + 1] > 0))),
ends AS (
  SELECT conv, arg_max(audit, length(audit)) AS audit, arg_max(lines, length(audit)) AS lines FROM walk GROUP BY conv),
pairs AS (
  SELECT conv, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair, i FROM turns),
sums AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM turns GROUP BY conv)
SELECT c.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate,
  coalesce(s.truncated, 0)::BIGINT AS truncated,
  coalesce((SELECT count(*) FROM pairs p WHERE p.conv = s.conv AND p.i > 1 AND p.pair NOT IN ('su', 'ua', 'au')), 0)::BIGINT AS illegal,
  coalesce(k.v[1], 0)::BIGINT AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations) c
LEFT JOIN sums s ON s.conv = c.conv LEFT JOIN costs k ON k.conv = c.conv AND k.i = 0 LEFT JOIN ends e ON e.conv = c.conv
"""

_ASSIGN_HEAD = ("(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
                "[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\\x22\\x27]?\\x20*[:=]\\x20*[\\x22\\x27]?")
#: Kind, head, body, least length of the body; fixed values, in the order of the kinds.
_SECRETS = (
    ("assign", _ASSIGN_HEAD, "[A-Za-z0-9+/_.=-]+", 6), ("access", "AKIA", "[A-Z0-9]+", 16), ("hex", "", "[0-9a-f]+", 24),
    ("github", "gh[oprsu]_", "[A-Za-z0-9]+", 36), ("pem", "-----BEGIN ", "(?:(?:RSA|DSA|EC|OPENSSH|ENCRYPTED) )?PRIVATE KEY-----", 1),
    ("slack", "xox[abprs]-", "[A-Za-z0-9-]+", 10), ("stripe", "[rs]k_live_", "[A-Za-z0-9]+", 16))


def _kind(number: int, kind: str, head: str, body: str, least: int) -> str:
    whole = head + body
    return f"""SELECT row, {number} AS number, '{kind}' AS kind, length(gap) AS gap, length(hit) AS size,
    length(hit) - length(regexp_extract(hit, '^(?:{head})')) >= {least} AS good, nr
  FROM (SELECT row, unnest(regexp_split_to_array(text, '{whole}')) AS gap,
          unnest(list_append(regexp_extract_all(text, '{whole}'), NULL)) AS hit, generate_subscripts(regexp_split_to_array(text, '{whole}'), 1) AS nr
        FROM texts)"""


SECRET_SPANS = f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
hits AS MATERIALIZED ({" UNION ALL ".join(_kind(i, *s) for i, s in enumerate(_SECRETS))}),
spans AS MATERIALIZED (
  SELECT row, number, kind, (stop - size)::BIGINT AS start, stop::BIGINT AS stop
  FROM (SELECT *, sum(gap + coalesce(size, 0)) OVER (PARTITION BY row, number ORDER BY nr) AS stop FROM hits)
  WHERE size IS NOT NULL AND good),
lists AS (
  SELECT row, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) FILTER (number < 3) AS base,
    {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))}
  FROM spans GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in ("assign", "access", "hex"))},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lists USING (row)
"""
