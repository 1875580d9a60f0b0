"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body, text,
    md5(concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), text)) AS key
  FROM documents
), pieces AS (
  SELECT row, doc_id, key, body,
    string_split(regexp_replace(body, '(\n|[.!?,;:][ \t]|[。！？，；：、])', '\1' || chr(1), 'g'), chr(1)) AS units
  FROM docs
), placed AS (
  SELECT row, doc_id, key, unit,
    sum(length(unit)) OVER upto - length(unit) AS start, sum(length(unit)) OVER upto AS stop,
    -- which line: how many line ends there are before
    sum((unit[-1:] = chr(10))::INT) OVER upto - (unit[-1:] = chr(10))::INT AS line,
    regexp_extract_all(lower(unit), '[\p{L}\p{N}]+') AS words
  FROM (SELECT row, doc_id, key, unnest(units) AS unit, generate_subscripts(units, 1) AS i FROM pieces)
  WINDOW upto AS (PARTITION BY row ORDER BY i)
), lines AS (
  SELECT row, doc_id, key, line, min(start) AS start, max(stop) AS stop, flatten(list(words ORDER BY start)) AS words
  FROM placed GROUP BY row, doc_id, key, line
), every AS (
  SELECT row, doc_id, key, line, start, stop, words, true AS whole FROM lines WHERE len(words) > 0
  UNION ALL
  SELECT p.row, p.doc_id, p.key, p.line, p.start, p.stop, p.words, false
  FROM placed p JOIN lines l USING (row, line)
  -- a character of an unspaced script counts as a word
  WHERE p.words <> l.words AND len(p.words) > 0 AND list_sum(list_transform(p.words, lambda w: greatest(1, len(regexp_extract_all(w,
    '[\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}]'))))) >= 8
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY list_aggregate(words, 'string_agg', ' ') ORDER BY doc_id NULLS LAST, key, start, row
  ) AS nth FROM every
), gone_lines AS (
  SELECT row, line, start, stop FROM ranked WHERE whole AND nth > 1
), gone AS (
  SELECT row, start, stop FROM gone_lines
  UNION ALL
  SELECT r.row, r.start, r.stop FROM ranked r WHERE NOT r.whole AND r.nth > 1
    AND NOT EXISTS (SELECT 1 FROM gone_lines g WHERE g.row = r.row AND g.line = r.line)
), cuts AS (
  SELECT row, count(*) AS n_cut,
    string_agg(start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start) AS cut
  FROM gone GROUP BY row
), marked AS (
  SELECT p.row, p.start, p.stop, p.unit, g.row IS NOT NULL AS gone
  FROM placed p LEFT JOIN gone g ON g.row = p.row AND g.start <= p.start AND g.stop >= p.stop
  WHERE p.stop > p.start
), stretches AS (
  SELECT row, min(start) AS start, max(stop) AS stop, string_agg(unit, '' ORDER BY start) AS part
  FROM (
    SELECT *, sum(gone::INT) OVER (PARTITION BY row ORDER BY start) AS run FROM marked
  ) WHERE NOT gone GROUP BY row, run
), kept AS (
  SELECT row, string_agg(part, '' ORDER BY start) AS text,
    string_agg(start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start) AS kept
  FROM stretches GROUP BY row
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
  coalesce(c.n_cut, 0) AS n_cut, coalesce(c.cut, '') AS cut, coalesce(k.kept, '') AS kept
FROM docs d LEFT JOIN cuts c USING (row) LEFT JOIN kept k USING (row)
"""

MIX_SOURCES = """
WITH mass AS (
  SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS mass FROM documents GROUP BY source
), rates AS (
  SELECT source, pow(mass, 0.5) / sum(pow(mass, 0.5)) OVER () * sum(mass) OVER () / mass AS rate
  FROM mass
), terms AS (
  SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::INT + 1)) AS k FROM rates
), logs AS (
  SELECT *, sum(ln(greatest(k, 1))) OVER (PARTITION BY source ORDER BY k) AS log_factorial FROM terms
), steps AS (
  SELECT source, sum(exp(k * ln(rate) - rate - log_factorial)) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM logs
), listed AS (
  SELECT source, list(upto ORDER BY upto) AS steps FROM steps GROUP BY source
), counted AS (
  SELECT d.*, len(list_filter(l.steps, lambda upto: upto <=
    ('0x' || md5('mix-1:' || key)[1:13])::BIGINT / 4503599627370496.0)) AS copies
  FROM (
    SELECT *, coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null') AS key FROM documents
  ) d JOIN listed l ON d.source IS NOT DISTINCT FROM l.source
)
SELECT doc_id, text, lang, source, n_chars, copy, md5('mix-1:' || key || ':' || copy) AS place
FROM (SELECT *, unnest(range(0, copies)) AS copy FROM counted)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS vector FROM embeddings
), sound AS MATERIALIZED (
  SELECT * FROM vectors WHERE label IS NOT NULL AND vector IS NOT NULL
    AND len(list_filter(vector, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(vector, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.row AS a, b.row AS b FROM sound a JOIN sound b
    ON a.label = b.label AND len(a.vector) = len(b.vector) AND a.row <> b.row
  WHERE list_cosine_similarity(a.vector, b.vector) >= 0.98
), reached AS (
  SELECT row AS a, row AS b FROM vectors
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), least AS (
  SELECT r.a AS row, min(v.vec_id) AS component_id
  FROM reached r JOIN vectors v ON v.row = r.b GROUP BY r.a
), counted AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, l.component_id,
  v.vec_id IS NOT DISTINCT FROM l.component_id AS kept
FROM vectors v JOIN least l USING (row) LEFT JOIN counted c USING (row)
"""

# crc32 of the id as decimal text, bit by bit
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"""

LEVELS = 6  # enough for 16 ** 6 rows of a source


def _merkle() -> str:
    """The tree level by level. A group with one node is done and passes through."""
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(concat(" + ", ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + "))"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS part, {leaf("text")} AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN {leaf(lower)} END AS changed FROM documents
), a0 AS (
  SELECT part, leaf AS node, count(*) OVER (PARTITION BY part) AS n, row,
    row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos FROM docs
), f0 AS (
  SELECT a.row, a.part, a.pos, a.leaf, coalesce(d.changed, a.leaf) AS node, '' AS proof
  FROM (SELECT row, part, pos, node AS leaf FROM a0) a JOIN docs d USING (row)
)"""
    ]

    def level(a: str, f: str, k: int) -> str:
        siblings = "array_to_string(r.slots[1:f.pos % 16], '')", "array_to_string(r.slots[f.pos % 16 + 2:], '')"
        left, right = (f"coalesce({s}, '')" for s in siblings)
        return f"""{a}r{k} AS (
  SELECT part, pos // 16 AS up, n, list(node ORDER BY pos) AS slots FROM {a}{k} GROUP BY part, up, n
), {a}{k + 1} AS (
  SELECT part, CASE WHEN n = 1 THEN slots[1] ELSE sha256(array_to_string(slots, '')) END AS node,
    (n + 15) // 16 AS n, up AS pos FROM {a}r{k}
), {f}{k + 1} AS (
  SELECT f.row, f.part, f.pos // 16 AS pos, f.leaf,
    CASE WHEN r.n = 1 THEN f.node ELSE sha256({left} || f.node || {right}) END AS node,
    f.proof || CASE WHEN r.n = 1 THEN '' ELSE {left} || {right} END AS proof
  FROM {f}{k} f JOIN {a}r{k} r ON f.part = r.part AND f.pos // 16 = r.up
)"""

    steps += [level("a", "f", k) for k in range(LEVELS)]
    steps.append(
        f"""b0 AS (
  SELECT '' AS part, node, count(*) OVER () AS n, row_number() OVER (ORDER BY part) - 1 AS pos, part AS source
  FROM a{LEVELS}
), g0 AS (
  SELECT f.row, '' AS part, b.pos, f.leaf, f.node, f.proof FROM f{LEVELS} f JOIN b0 b ON f.part = b.source
)"""
    )
    steps += [level("b", "g", k) for k in range(LEVELS)]
    return f"""WITH {", ".join(steps)}
SELECT d.doc_id, d.leaf, s.node AS subroot, b.node AS root, sha256(g.proof) AS proof_sha256,
  g.node AS folded_root, g.node = b.node AS verified
FROM g{LEVELS} g JOIN docs d USING (row) JOIN b0 s ON s.source = d.part CROSS JOIN b{LEVELS} b"""


MERKLE_MANIFEST = _merkle()

PERIODIC_RUNS = (
    r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, """
    + _CRC32
    + r""" AS h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sized AS (
  SELECT *, len(words) AS n, h // 10 AS g, (h // 10) % greatest(len(words), 1) AS a FROM docs
), places AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM sized
), tokens AS (
  SELECT row, n, i, words[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM places
), equal AS (
  SELECT x.row, x.n, x.i, y.i - x.i AS q FROM tokens x JOIN tokens y
  ON x.row = y.row AND x.word = y.word AND x.i < y.i AND 3 * (y.i - x.i) <= x.n
), numbered AS (
  SELECT row, i, q, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS stretch FROM equal
), stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length FROM numbered GROUP BY row, q, stretch
  HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.row = s.row AND t.q < s.q
      AND t.start <= s.start AND t.start + t.length >= s.start + s.length)
), listed AS (
  SELECT row, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
  FROM runs GROUP BY row
), best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs b WHERE b.row = r.row AND (b.length * r.q > r.length * b.q
      OR b.length * r.q = r.length * b.q AND (b.start < r.start OR b.start = r.start AND b.q < r.q)))
), kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM tokens t WHERE NOT EXISTS (
    SELECT 1 FROM runs r WHERE r.row = t.row AND t.i >= r.start + r.q AND t.i < r.start + r.length)
  GROUP BY row
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.q AS period,
  1000 * b.length // b.q AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
  sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l USING (row) LEFT JOIN best b USING (row) LEFT JOIN kept k USING (row)
"""
)

SQL: dict[str, str] = {
    "op4_embedding_dedup": EMBEDDING_DEDUP,
    "op3_line_dedup": LINE_DEDUP,
    "op9_mix_sources": MIX_SOURCES,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_periodic_runs": PERIODIC_RUNS,
}
