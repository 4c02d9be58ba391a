"""DuckDB SQL for the operators whose rows SQL gives."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: Filters as flags of each document, summed for every order and step.
FILTER_AUDIT = rf"""
WITH lb AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels
            WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT d.*, regexp_extract_all(t, '{_WORD}') AS ws, min(doc_id) OVER (PARTITION BY t) AS lo FROM d),
f AS (SELECT part, concat(CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END,
             CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
             CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END,
             CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
             CASE WHEN doc_id > lo THEN 'E' ELSE '' END) AS fails,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM w LEFT JOIN lb USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY 1, 2),
l(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS letter,
             substr(filter_order, 1, i - 1) AS before FROM o, range(1, 6) r(i)),
j AS (SELECT m.*, s.*, contains(fails, letter) AS fail,
             before <> '' AND regexp_matches(fails, '[' || before || '.]') AS gone FROM m, s),
a AS (SELECT part, filter_order, step, letter, sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fail AND gone THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fail AND NOT gone THEN g ELSE 0 END) AS good_lost,
             sum(CASE WHEN fail AND NOT gone THEN x ELSE 0 END) AS toxic_lost
      FROM j GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM a"""

#: CRC-32 of an ASCII string, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""


def _best(*ways: str) -> str:
    """The least of ways, texts of a ten-digit cost and the audit (NULL: no way)."""
    return f"least({', '.join(ways)})"


def _way(state: str, cost: str, edit: str) -> str:
    return f"(lpad(CAST(CAST(substr({state}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({state}, 11) || '{edit}')"


def _inserted(user: str, assistant: str, others: tuple[str, ...]) -> tuple[str, str]:
    u = _best(user, *[_way(s, "5", "I") for s in (*others, assistant)])
    return u, _best(assistant, _way(f"({u})", "5", "I"))


_S2, _S3 = _inserted("p.s2", "p.s3", ("p.s0", "p.s1"))
_KEEP = "CASE WHEN NOT x.gone AND x.initial = '{0}' THEN {1} END"
_REROLE = "CASE WHEN NOT x.gone THEN {0} END"


def _kept(initial: str, state: str) -> str:
    return _KEEP.format(initial, _way(state, "x.extra", "K"))


def _rerole(state: str) -> str:
    return _REROLE.format(_way(state, "x.extra + 1", "R"))


_F2, _F3 = _inserted("s2", "s3", ("s0", "s1"))

#: Damage, faults, the four-state programme row by row, and the repaired text from the audit.
CONVERSATION_REPAIR = f"""
WITH RECURSIVE
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
      FROM conversations),
dm AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
              CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
              unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
             substr(role, 1, 1) AS initial, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS cut FROM dm),
q AS (SELECT *, cut = '' AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM n),
x AS (SELECT *, blank OR seen AS gone,
             CASE WHEN NOT blank AND NOT seen AND right(cut, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS extra FROM q),
p AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '0000000000' AS s0, CAST(NULL AS VARCHAR) AS s1,
             CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM x
      UNION ALL
      SELECT r.conv_id, r.i, r.d0, least(r.d1, r.k1), least(r.d2, r.k20, r.k21, r.k23), least(r.d3, r.k32) FROM (
        SELECT x.conv_id, x.i, {_way("p.s0", "2", "D")} AS d0, {_way("p.s1", "2", "D")} AS d1,
               {_way(f"({_S2})", "2", "D")} AS d2, {_way(f"({_S3})", "2", "D")} AS d3,
               {_kept("s", "p.s0")} AS k1,
               {_best(_kept("u", "p.s0"), _rerole("p.s0"))} AS k20, {_best(_kept("u", "p.s1"), _rerole("p.s1"))} AS k21,
               {_best(_kept("u", f"({_S3})"), _rerole(f"({_S3})"))} AS k23,
               {_best(_kept("a", f"({_S2})"), _rerole(f"({_S2})"))} AS k32
        FROM p JOIN x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.i = p.i + 1) r),
e AS (SELECT conv_id, least(s0, {_F3}) AS best FROM p
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
ed AS (SELECT conv_id, u.edit, u.j, sum(CASE WHEN u.edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY u.j) AS i
       FROM (SELECT conv_id, unnest(list_transform(range(1, length(best) - 9),
                    lambda j: {{'j': j, 'edit': substr(best, CAST(10 + j AS INTEGER), 1)}})) AS u FROM e)),
ln AS (SELECT ed.*, x.role, x.text, coalesce(max(CASE WHEN ed.edit = 'K' AND x.initial = 's' THEN 1 END)
              OVER (PARTITION BY ed.conv_id), 0) AS sys,
              row_number() OVER (PARTITION BY ed.conv_id ORDER BY ed.j) AS line
       FROM ed LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM ed.conv_id AND x.i = ed.i AND ed.edit <> 'I'
       WHERE ed.edit <> 'D'),
rp AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (line - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
              || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY line) AS body FROM ln GROUP BY 1),
st AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
              count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
              count(*) FILTER (extra > 0) AS truncated,
              count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
       FROM x GROUP BY 1),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(CAST(substr(best, 1, 10) AS BIGINT), 0) AS cost,
       coalesce(substr(best, 11), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM ids LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN rp ON rp.conv_id IS NOT DISTINCT FROM ids.conv_id"""
