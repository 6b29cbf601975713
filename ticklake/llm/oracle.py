"""SQL twins of the operators' queries (DuckDB dialect), where SQL can express them."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: unsigned CRC-32 of the decimal doc_id, bit by bit
_CRC32 = """xor(4294967295, list_reduce([ascii(x) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')],
      lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384)), 4294967295))"""

#: nodes ``n(id)`` and links ``l(a, b)`` in both directions to ``c(id, component)``
_COMPONENTS = """reach(id, other) AS (
    SELECT id, id FROM n UNION SELECT r.id, l.b FROM reach r JOIN l ON r.other = l.a),
  c AS (SELECT id, min(other) AS component FROM reach GROUP BY id)"""


def _sketch(text: str) -> str:
    """struct(whole, hashes) of a text, see scaled_sketch."""
    words = f"regexp_extract_all({text}, {_WORDS})"
    hashes = "[md5(array_to_string(w[i:i + 4], ' ')) FOR i IN range(1, greatest(len(w) - 3, 2))]"
    of_words = f"list_transform([{words}], lambda w: {{'whole': len(w) <= 132, 'hashes': CASE WHEN len(w) = 0 THEN [] ELSE {hashes} END}})[1]"
    return f"list_transform([{of_words}], lambda s: {{'whole': s.whole, 'hashes': list_sort(list_distinct([substr(h, 1, 16) FOR h IN s.hashes IF s.whole OR h < '2']))}})[1]"


def _fingerprint(of: str) -> str:
    return f"CASE WHEN {of}.whole THEN '1:' ELSE '8:' END || array_to_string({of}.hashes, '')"


def _likeness(a: str, b: str) -> str:
    left, right = (f"(CASE WHEN {x}.whole AND NOT {y}.whole THEN [h FOR h IN {x}.hashes IF h < '2'] ELSE {x}.hashes END)" for x, y in ((a, b), (b, a)))
    both = f"len(list_intersect({left}, {right}))"
    total = f"(len({left}) + len({right}) - {both})"
    return f"CASE WHEN {total} > 0 THEN {both}::DOUBLE / {total} ELSE (len({a}.hashes) + len({b}.hashes) = 0)::INT::DOUBLE END"


ORACLE: dict[str, str] = {
    "op1_minhash_dedup": f"""WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORDS}) AS w FROM documents),
  s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
  sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
  l AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
  n AS (SELECT doc_id AS id FROM documents), {_COMPONENTS}
  SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component AS component_id, id = component AS kept FROM c LEFT JOIN sizes ON doc_id = id""",
    "op2_ball_tree": """WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings),
  r AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
  SELECT query_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id, score FROM r
  WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER o <= 20""",
    "op4_line_dedup": f"""WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
  l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos FROM s),
  k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
  often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
  m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often ON k.key = often.key)
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id""",
    "op7_substring_dedup": f"""WITH s AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS s FROM documents),
  w AS (
    SELECT doc_id, unnest(s) AS word, generate_subscripts(s, 1) AS pos,
      unnest([CASE WHEN i <= len(s) - 49 THEN md5(array_to_string(s[i:i + 49], ' ')) END FOR i IN range(1, len(s) + 1)]) AS h FROM s),
  f AS (SELECT *, h IS NOT NULL AND min(doc_id) OVER (PARTITION BY h) < doc_id AS again FROM w),
  g AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
  r AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
  FROM documents LEFT JOIN r USING (doc_id)""",
    "op9_embedding_dedup": f"""WITH RECURSIVE v AS (SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
  l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
  n AS (SELECT vec_id AS id FROM embeddings), {_COMPONENTS},
  d AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
  SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component AS component_id, id = component AS kept FROM c LEFT JOIN d ON a = id""",
    "op10_mixing": rf"""WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size,
      greatest(0.05::DOUBLE, coalesce(length(regexp_replace(text, '[^\p{{L}}]+', '', 'g'))::DOUBLE / nullif(length(text), 0), 0)) AS quality,
      (CAST('0x' || substr(md5('0|' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496 AS u
    FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
  w AS (SELECT *, ([5, 2, 1])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight, source_size * 3::DOUBLE AS cap FROM s),
  x AS (
    SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
  common AS (SELECT arg_min(level, cap / weight) AS level FROM x WHERE level * weight <= cap),
  t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM common) * weight, cap)) AS target FROM x),
  e AS (SELECT *, CAST(coalesce(floor(target / nullif(source_size, 0)), 0) AS BIGINT) AS epochs FROM t),
  p AS (
    SELECT d.*, e.* EXCLUDE (source), CASE WHEN epochs < 3 THEN target - epochs * source_size ELSE 0 END AS rest,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / quality, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
  SELECT doc_id, size, source_size, target,
    size * (epochs + CASE WHEN before + size / 2::DOUBLE <= rest THEN 1 ELSE 0 END) AS taken FROM p""",
    # a run holds two whole blocks in a row of those that start at multiples of its period
    "op11_periodic_runs": f"""WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w, len(w) AS n, {_CRC32} AS h, h // 10 AS g FROM documents),
  a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - a) // (3 + g % 8) END AS p FROM d),
  s AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
      THEN [w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] FOR i IN range(0, n)] ELSE w END AS s FROM a),
  p AS (SELECT doc_id, unnest(s) AS word, generate_subscripts(s, 1) - 1 AS i FROM s),
  b AS (
    SELECT doc_id, q, unnest(range(0, n - 2 * q + 1, q)) AS i
    FROM (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM s)),
  c AS (
    SELECT DISTINCT doc_id, q FROM b JOIN p x USING (doc_id, i) JOIN p y ON y.doc_id = b.doc_id AND y.i = b.i + q AND x.word = y.word
    JOIN s ON s.doc_id = b.doc_id WHERE s[b.i + 1:b.i + q] = s[b.i + q + 1:b.i + 2 * q]),
  e AS (SELECT doc_id, q, s, unnest(range(1, n - q + 1)) AS i FROM c JOIN s USING (doc_id)),
  f AS (SELECT doc_id, q, i, s[i] = s[i + q] AS same FROM e),
  k AS (SELECT *, count(*) FILTER (NOT same) OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM f),
  m AS (
    SELECT doc_id, q, min(i) - 1 AS start, count(*) + q AS length FROM k WHERE same
    GROUP BY doc_id, q, stretch HAVING length >= greatest(6, 4 * q)),
  r AS (SELECT doc_id, start, length, min(q) AS period FROM m GROUP BY doc_id, start, length),
  gone AS (SELECT DISTINCT p.doc_id, p.i FROM p JOIN r ON p.doc_id = r.doc_id AND i >= start + period AND i < start + length),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM p LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY doc_id),
  t AS (
    SELECT doc_id, count(*) AS n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, [length, -start, -period]) AS top,
      string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id)
  SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.p AS period, 1000 * top.l // top.p AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
  FROM s LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_filter_audit": f"""WITH first AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first FROM documents GROUP BY ALL),
  d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
  f AS (
    SELECT part, quality = 1 AS good, toxic = 1 AS bad, [
      len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
      regexp_matches(t, '[#$%&*|]'), first < doc_id] AS fails
    FROM d JOIN first USING (t) LEFT JOIN labels USING (doc_id)),
  c AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, fails, count(*) AS n FROM f GROUP BY ALL),
  l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
  o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
  s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
  r AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, n, good, bad, fails[ascii(filter_order[step]) - 64] AS own,
      list_bool_or([fails[ascii(filter_order[i]) - 64] FOR i IN range(1, step)] || [false]) AS earlier,
      len([x FOR x IN fails IF x]) = 1 AS once, filter_order[step] AS x
    FROM c, s),
  g AS (
    SELECT part, filter_order, step, x, sum(n) FILTER (NOT earlier AND NOT own) AS kept, sum(n) FILTER (NOT earlier AND own) AS removed,
      sum(n) FILTER (earlier AND own) AS redundant, sum(n) FILTER (own AND once) AS unique_fails,
      sum(n) FILTER (NOT earlier AND own AND good) AS good_lost, sum(n) FILTER (NOT earlier AND own AND bad) AS toxic_lost
    FROM r GROUP BY ALL)
  SELECT part, filter_order, step, {", ".join(f"CAST(coalesce({x}, 0) AS BIGINT) AS {x}" for x in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM g""",
    "op13_scaled_sketch": f"""WITH n AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS next
    FROM documents WINDOW o AS (ORDER BY doc_id NULLS FIRST)),
  e AS (SELECT *, left(t, length(t) - length(t) // 4) || left(next, length(t) // 4) AS edited FROM n),
  x AS (SELECT doc_id, length(t) AS n_chars, sha256(edited) AS edited_sha256, {_sketch("t")} AS own, {_sketch("edited")} AS ed, {_sketch("next")} AS nx FROM e)
  SELECT doc_id, n_chars, edited_sha256, {_fingerprint("own")} AS fingerprint, {_fingerprint("ed")} AS edited_fingerprint,
    {_likeness("own", "ed")} AS near_edited, {_likeness("own", "nx")} AS near_next FROM x""",
}
