"""DuckDB SQL that gives the rows of the corpus queries that SQL can express."""

from __future__ import annotations

REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS w
  FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 99)) AS i FROM docs)),
later AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
begins AS (
  SELECT doc_id, i, CASE WHEN i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS new
  FROM later),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM begins),
spans AS (SELECT doc_id, span, min(i) AS b, max(i) + 100 AS e FROM numbered GROUP BY doc_id, span),
gaps AS (SELECT doc_id, b, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY b) AS after FROM spans),
lists AS (
  SELECT doc_id, list({'x': after, 'y': b} ORDER BY b) AS kept, max(e) AS tail, sum(e - b) AS n_removed, count(*) AS n_spans
  FROM gaps GROUP BY doc_id)
SELECT d.doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(concat(array_to_string(list_transform(coalesce(kept, []), lambda r: substr(h, 2 * r.x + 1, 2 * (r.y - r.x))), ''),
    substr(h, 2 * coalesce(tail, 0) + 1)))) AS kept_sha256
FROM docs d LEFT JOIN lists USING (doc_id)
"""

SHINGLES = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
spread AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
      lambda i: array_to_string(w[i:i + 2], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM spread GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM spread a JOIN spread b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
arcs AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reached AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT r.u, b.v FROM reached r JOIN arcs b ON b.u = r.v),
least AS (SELECT u, min(v) AS component_id FROM reached GROUP BY u)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least l ON l.u = d.doc_id
"""


def curve_sql(bits: int = 5, shards: int = 8) -> str:
    """The Hilbert shards: the curve's steps unrolled, one subquery each."""
    top = (1 << bits) - 1
    names = ("size", "source", "lang")
    steps = ", ".join(["h0 AS (SELECT *, size_cell AS x0, source_cell AS x1, lang_cell AS x2 FROM cells)"])
    last = "h0"
    k = 0
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(3):
            k += 1
            if i == 0:
                fields = f"CASE WHEN x0 & {q} <> 0 THEN xor(x0, {low}) ELSE x0 END AS x0, x1, x2"
            else:
                swap = f"(xor(x0, x{i}) & {low})"
                own = f"CASE WHEN x{i} & {q} <> 0 THEN x{i} ELSE xor(x{i}, {swap}) END AS x{i}"
                other = "x2" if i == 1 else "x1"
                fields = f"CASE WHEN x{i} & {q} <> 0 THEN xor(x0, {low}) ELSE xor(x0, {swap}) END AS x0, {own}, {other}"
            steps += f", h{k} AS (SELECT * EXCLUDE (x0, x1, x2), {fields} FROM {last})"
            last = f"h{k}"
    flip = "0"
    for b in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN g2 & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    places = [(b, i) for b in range(bits - 1, -1, -1) for i in range(3)]
    index = " | ".join(f"(((xor(g{i}, f) >> {b}) & 1) << {len(places) - 1 - n})" for n, (b, i) in enumerate(places))
    code = "CAST('0x' || rpad(left(hex(encode(coalesce({0}, ''))), 12), 12, '0') AS BIGINT)::DOUBLE"
    magnitude = "bin(greatest(size, 2))"
    cells = ", ".join(
        f"CAST(CASE WHEN max({n}_code) OVER () > min({n}_code) OVER () THEN least(floor(({n}_code - min({n}_code) OVER ()) * {1 << bits}"
        f" / (max({n}_code) OVER () - min({n}_code) OVER ())), {top}) ELSE 0 END AS BIGINT) AS {n}_cell" for n in names)
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    return f"""
WITH RECURSIVE turns AS (
  SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS byte, 0 AS k, byte AS v
  UNION ALL SELECT byte, k + 1, {step} FROM turns WHERE k < 8),
checks AS (SELECT list(v ORDER BY byte) AS codes FROM turns WHERE k = 8),
hexed AS (SELECT doc_id, source, lang, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
  SELECT doc_id, source, lang, CAST(strlen(h) // 2 + 1 AS BIGINT) AS size, CAST(xor(list_reduce(
    list_transform(range(0, strlen(h) // 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
      + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS BIGINT)),
    lambda t, b: xor(t >> 8, codes[(xor(t, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS BIGINT) AS text_crc32
  FROM hexed, checks),
coded AS (
  SELECT doc_id, size, text_crc32, CAST(2 * length({magnitude}) + CAST(substr({magnitude}, 2, 1) AS INT) AS DOUBLE) AS size_code,
    {code.format('source')} AS source_code, {code.format('lang')} AS lang_code FROM sized),
cells AS (SELECT doc_id, size, text_crc32, {cells} FROM coded),
{steps},
gray AS (SELECT *, x0 AS g0, xor(x1, x0) AS g1, xor(x2, xor(x1, x0)) AS g2 FROM {last}),
flips AS (SELECT *, {flip} AS f FROM gray),
curves AS (SELECT doc_id, size, text_crc32, size_cell, source_cell, lang_cell, CAST({index} AS BIGINT) AS curve FROM flips),
ranks AS (SELECT *, row_number() OVER (ORDER BY curve, doc_id) - 1 AS place, count(*) OVER () AS total FROM curves),
cut AS (
  SELECT *, CAST(CASE WHEN place < (total % {shards}) * (total // {shards} + 1) THEN place // (total // {shards} + 1)
    ELSE total % {shards} + (place - (total % {shards}) * (total // {shards} + 1)) // greatest(total // {shards}, 1) END AS INTEGER) AS shard
  FROM ranks)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, curve, size_cell, source_cell, lang_cell
FROM cut
"""


COPIES = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS whole,
    translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW best AS (PARTITION BY norm ORDER BY length(whole) DESC, doc_id NULLS LAST)
"""


COLLOCATIONS = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM runs
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM runs
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM runs),
f AS (SELECT lang, size, phrase, count(*) AS c FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND c >= 10),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
parts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM cuts),
scores AS (
  SELECT p.*, u.c AS l, v.c AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(u.c AS HUGEINT) * v.c) AS BIGINT) AS score
  FROM parts p JOIN f u ON u.lang = p.lang AND u.phrase = p.x JOIN f v ON v.lang = p.lang AND v.phrase = p.y),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidates WHERE size = 3)
  GROUP BY lang, phrase),
kept AS (
  SELECT q.* FROM lowest q LEFT JOIN around o ON o.lang = q.lang AND o.phrase = q.phrase AND q.size = 2
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


ORACLES = {
    "op2_repeated_strings": REPEATS,
    "op6_shingle_join": SHINGLES,
    "op9_hilbert_shards": curve_sql(),
    "op11_exact_copies": COPIES,
    "op12_collocations": COLLOCATIONS,
}
