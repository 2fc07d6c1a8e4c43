"""DuckDB SQL of the operators whose results SQL can express."""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM docs),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key AS gone FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared ON key = gone GROUP BY r, doc_id
"""


def _way(price: str, letter: str, to: str, line: str | None = None) -> str:
    out = f"{to}.o" if line is None else f"list_prepend({line}, {to}.o)"
    return f"{{'c': {price} + {to}.c, 'a': '{letter}' || {to}.a, 'o': {out}}}"


def _row_ways(state: str, initials: dict[str, str], free: str) -> str:
    """The best way over one row from a state: ``initials`` has the state after each role that may be kept,
    ``free`` the one after user or assistant."""
    role = {"u": "user", "a": "assistant"}[free]
    ways = [_way("4", "D", f"w.{state}")]
    ways += [f"CASE WHEN NOT must AND initial = '{i}' THEN {_way('extra', 'K', f'w.{to}', 'line')} END" for i, to in initials.items()]
    ways.append(f"CASE WHEN NOT must THEN {_way('3 + extra', 'R', f'w.{free}', f"'{role}:' || text")} END")
    return f"list_min([{', '.join(ways)}]) AS {state}"


OP12 = r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                        lambda c: ascii(c)::BIGINT) AS bytes FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, b:
    list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, bit:
      CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 20 AS h FROM source),
damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE h WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed WHERE h <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial, role || ':' || text AS line,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
rows_ AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM faults),
walk AS (
  SELECT conv_id, count(*) + 1 AS i, {'c': 0, 'a': '', 'o': []::VARCHAR[]} AS s,
         {'c': 6, 'a': 'II', 'o': ['user:', 'assistant:']} AS y, {'c': 3, 'a': 'I', 'o': ['assistant:']} AS u,
         {'c': 0, 'a': '', 'o': []::VARCHAR[]} AS a
  FROM rows_ GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, list_min([s, INSERT_U]) AS s, list_min([y, INSERT_U]) AS y, u, a FROM (
    SELECT conv_id, i, s, y, list_min([u, INSERT_A]) AS u, list_min([a, INSERT_U]) AS a FROM (
      SELECT r.conv_id, r.i, ROW_WAYS FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1) AS over_row) AS inserted),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
best AS (SELECT conv_id, s FROM walk WHERE i = 1)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s.c, 0)::BIGINT AS cost,
       coalesce(s.a, '') AS audit, sha256(coalesce(array_to_string(s.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e
LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM e.conv_id
""".replace("INSERT_U", _way("3", "I", "u", "'user:'")).replace("INSERT_A", _way("3", "I", "a", "'assistant:'")).replace(
    "ROW_WAYS", ", ".join([_row_ways("s", {"s": "y", "u": "u"}, "u"), _row_ways("y", {"u": "u"}, "u"),
                           _row_ways("u", {"a": "a"}, "a"), _row_ways("a", {"u": "u"}, "u")]))
