"""DuckDB SQL for the queries of this subpackage that SQL can state."""

from __future__ import annotations

OP9 = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM sources),
capped AS (
  SELECT *, turn % 3 + 1 AS weight, source_size * 3 AS cap FROM ranked),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT
             - coalesce(sum(cap) OVER early, 0)::BIGINT)::DOUBLE
            / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER early, 0)::BIGINT)::DOUBLE AS level
  FROM capped
  WINDOW early AS (ORDER BY cap::DOUBLE / weight::DOUBLE, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, turn, source_size,
         round(least(cap::DOUBLE, (max(level) OVER ()) * weight), 6) AS target
  FROM levels),
sent AS (
  SELECT s.doc_id, s.size, t.turn, t.source_size, t.target, s.key,
         (sum(s.size) OVER (PARTITION BY t.turn ORDER BY s.key, s.doc_id, s.size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
readings AS (
  SELECT s.*, e.e, (sent + source_size * e.e)::DOUBLE / target AS finish
  FROM sent s, (SELECT unnest([0, 1, 2]) AS e) e WHERE size > 0 AND target > 0),
queue AS (
  SELECT *, sum(size) OVER (ORDER BY finish, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM readings),
taken AS (
  SELECT doc_id, turn, sent, sum(size)::BIGINT AS taken FROM queue
  WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id, turn, sent)
SELECT s.doc_id, s.size::BIGINT AS size, s.source_size, s.target,
       CASE WHEN s.size > 0 THEN coalesce(t.taken, 0) ELSE 0 END::BIGINT AS taken
FROM sent s LEFT JOIN taken t ON s.doc_id = t.doc_id AND s.turn = t.turn AND s.sent = t.sent
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, p.i AS piece, doc,
         regexp_extract_all(p.t, '[^\x20\x09]+') AS words
  FROM (SELECT lang, row_number() OVER () AS doc,
               string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[.,;:!?\x0A-\x0D]') AS parts
        FROM documents WHERE text IS NOT NULL) d,
       (SELECT unnest(d.parts) AS t, generate_subscripts(d.parts, 1) AS i) p),
words AS (
  SELECT lang, doc, piece, u.i AS place, u.w AS w1,
         lead(u.w, 1) OVER next AS w2, lead(u.w, 2) OVER next AS w3
  FROM pieces, (SELECT unnest(words) AS w, generate_subscripts(words, 1) AS i) u
  WINDOW next AS (PARTITION BY doc, piece ORDER BY u.i)),
f1 AS (SELECT lang, w1, count(*)::HUGEINT AS f FROM words GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM words WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM words WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, count(*)::BIGINT AS n FROM words GROUP BY lang),
longer AS (
  SELECT lang, w1, w2, max(f) AS f
  FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) x GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  LEFT JOIN longer o ON o.lang = c.lang AND o.w1 = c.w1 AND o.w2 = c.w2
  WHERE c.f >= 10 AND (o.f IS NULL OR 100 * o.f < 50 * c.f)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
  JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM cuts),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS best FROM scored) x WHERE best = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, s.n,
       r.score::BIGINT AS score
FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= 2000
"""


def statements() -> dict[str, str]:
    return {"op9_source_mixing": OP9, "op11_phrase_collocations": OP11}
