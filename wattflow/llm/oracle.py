"""DuckDB SQL of the operators that SQL can express over the driver tables."""

from __future__ import annotations

from . import line_dedup, mixing, phrases, quality, vantage, warc

_CLASS = r"[^\x20\x09-\x0D]+"
_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LINE = f"array_to_string(regexp_extract_all(regexp_replace(translate(line, {_ABC}), '[0-9]', '0', 'g'), '{_CLASS}'), ' ')"

WARC = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM r
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_CLASS}') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
seen AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS k FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM seen WHERE k > 1),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

def _near(docs: str) -> str:
    """Classes of near copies (comp: doc_id, component_id) of the documents in ``docs``."""
    return f"""nw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ABC}), '{_CLASS}') AS ws FROM documents WHERE doc_id IN (SELECT doc_id FROM {docs})),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM nw WHERE len(ws) > 0)),
shsize AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_ JOIN shsize p ON p.doc_id = x JOIN shsize q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM nw UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)"""


# lines with a word, folded; those that too many distinct texts of a host hold; of them those that too many families hold
_LINES = f"""
raw AS (SELECT doc_id, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
lines AS (SELECT *, {_LINE} AS folded FROM raw),
hosts AS (SELECT source, count(DISTINCT coalesce(text, chr(0))) AS n_host FROM documents GROUP BY 1),
maybe AS (SELECT source, folded, n_host FROM (SELECT source, folded, count(DISTINCT text) AS n FROM lines WHERE folded <> '' GROUP BY 1, 2)
  JOIN hosts USING (source) WHERE n > {{least}} AND n > {{ratio}} * n_host),
held AS (SELECT DISTINCT source, folded, n_host, doc_id FROM lines JOIN maybe USING (source, folded)),
{_near('held')},
often AS (SELECT source, folded FROM held JOIN comp USING (doc_id) GROUP BY source, folded, n_host
  HAVING count(DISTINCT component_id) > {{least}} AND count(DISTINCT component_id) > {{ratio}} * n_host)"""

QUALITY = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_CLASS}') AS ws FROM documents),
{_LINES.format(least=quality.MIN_DOCUMENTS, ratio=quality.HOST_RATIO)},
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE folded <> '' GROUP BY 1),
lost AS (SELECT doc_id, sum(len(regexp_extract_all(line, '{_CLASS}'))) AS n FROM lines SEMI JOIN often USING (source, folded) GROUP BY 1),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 2], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM tri WHERE k > 1) GROUP BY 1),
base AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  CAST(coalesce(lost.n, 0) AS BIGINT) AS n_line_words
  FROM w LEFT JOIN dup ON w.doc_id = dup.doc_id LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN lost ON w.doc_id = lost.doc_id)
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words) AND 100 * n_line_words <= {quality.DEPLETED_PERCENT} * n_words AS kept
FROM base
"""

LINE_DEDUP = f"""
WITH RECURSIVE {_LINES.format(least=line_dedup.MIN_PAGES, ratio=line_dedup.BOILERPLATE_RATIO)},
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM lines ANTI JOIN often USING (source, folded) GROUP BY 1),
total AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY 1)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, total.n - coalesce(kept.n, 0) AS n_removed
FROM documents d JOIN total ON d.doc_id = total.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

NEAR = f"""
WITH RECURSIVE {_near('documents')}
SELECT comp.doc_id, coalesce(shsize.n, 0) AS n_shingles, component_id, comp.doc_id = component_id AS kept FROM comp LEFT JOIN shsize ON comp.doc_id = shsize.doc_id
"""

_W = ", ".join(str(x) for x in mixing.WEIGHTS)


def _round(r: int) -> str:
    """One round of filling: what is still out and no larger than the gap, in rank order, as far as it fits."""
    fits = "NOT more AND size <= gap"
    return f"""e{r} AS (SELECT *, CASE WHEN {fits} THEN sum(CASE WHEN {fits} THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank, doc_id) END AS upto FROM k{r - 1}),
k{r} AS (SELECT source, doc_id, text, size, rank, gap - coalesce(sum(size) FILTER (WHERE upto <= gap) OVER (PARTITION BY source), 0) AS gap, more OR coalesce(upto <= gap, FALSE) AS more FROM e{r}),"""


MIXING = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(text, '') AS text, CAST(len(regexp_extract_all(coalesce(text, ''), '{_CLASS}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS i FROM d GROUP BY 1),
r AS (SELECT *, [{_W}][i % {len(mixing.WEIGHTS)} + 1] AS weight, {mixing.MOST_COPIES} * source_size AS cap FROM s),
u AS (SELECT *, cap / weight AS unit FROM r),
run AS (SELECT *, sum(cap) OVER (ORDER BY unit, i) AS capped, sum(weight) OVER (ORDER BY unit, i) AS used, {mixing.SHARE} * sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights FROM u),
c AS (SELECT *, budget - capped + cap >= unit * (weights - used + weight) AS is_capped FROM run),
t AS (SELECT source, source_size, CASE WHEN is_capped THEN cap ELSE (budget - coalesce(sum(cap) FILTER (WHERE is_capped) OVER (), 0)) / sum(weight) FILTER (WHERE NOT is_capped) OVER () * weight END AS target FROM c),
o AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS owed FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CAST(floor(owed) AS BIGINT) AS whole, owed - floor(owed) AS p,
  (CAST('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(text))), 1, 10) AS BIGINT) + 0.5) / 1099511627776.0 AS u FROM o),
k0 AS (SELECT source, doc_id, text, size, u * (1 - p) / ((1 - u) * p) AS rank, target - floor(target / greatest(source_size, 1)) * source_size AS gap, FALSE AS more
  FROM q WHERE p > 0 AND size > 0),
{{rounds}}
z AS (SELECT doc_id, text, more OR (NOT more AND size <= 2 * gap AND row_number() OVER (PARTITION BY source ORDER BY NOT more AND size <= 2 * gap DESC, rank, doc_id) = 1) AS more FROM k{mixing.ROUNDS})
SELECT q.doc_id, q.size, q.source_size, q.target, CAST((q.whole + coalesce(z.more, FALSE)::INT) * q.size AS BIGINT) AS taken, q.source
FROM q LEFT JOIN z ON q.doc_id = z.doc_id
""".replace("{rounds}", "\n".join(_round(r) for r in range(1, mixing.ROUNDS + 1)))

NEIGHBOURS = f"""
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
both_ AS (SELECT q.vec_id AS query_id, o.vec_id, list_cosine_similarity(q.v, o.v) AS score FROM v q JOIN v o ON q.vec_id <> o.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM both_ QUALIFY rank <= {vantage.NEIGHBOURS}
"""

PHRASES = f"""
WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
  SELECT coalesce(lang, '{phrases.NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_ABC}), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY 1),
g AS (SELECT lang, ws[i:i + k - 1] AS ws FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {phrases.MOST} + 1)) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, ws, count(*) AS f FROM g GROUP BY 1, 2),
c AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) >= {phrases.LEAST} AND f >= {phrases.LEAST_COUNT}),
part AS (SELECT lang, a, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM (SELECT lang, ws, a, unnest(range({phrases.LEAST}, len(ws))) AS k FROM c)),
inside AS (SELECT lang, ws[i:i + k - 1] AS ws, max(a) AS longest FROM part GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inside ON c.lang = inside.lang AND c.ws = inside.ws WHERE longest IS NULL OR 100 * longest < 100 * a),
cut AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM kept),
scored AS (SELECT cut.lang, cut.ws, cut.k, cut.a, x.f AS l, y.f AS r, n.n, CAST((CAST(1000 AS HUGEINT) * cut.a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN n ON n.lang = cut.lang JOIN f x ON x.lang = cut.lang AND x.ws = cut.ws[:cut.k] JOIN f y ON y.lang = cut.lang AND y.ws = cut.ws[cut.k + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(ws, ' '))) AS rank, array_to_string(ws, ' ') AS phrase, a, l, r, n, score
FROM best QUALIFY rank <= {phrases.LIMIT}
"""
