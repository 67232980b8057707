"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_GAP = r"[\x20\x09-\x0D]"

_OP2 = rf"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS r
  FROM documents
), lines AS (
  SELECT doc_id, r, raw, regexp_replace(regexp_replace(raw, '^{_GAP}+', ''), '{_GAP}+$', '') AS x
  FROM split
), words AS (
  SELECT doc_id, r, x, row_number() OVER (PARTITION BY doc_id ORDER BY r) AS k,
         len(string_split_regex(x, '{_GAP}+')) AS w
  FROM lines WHERE x <> ''
), sums AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM words
), spans AS (
  SELECT s.doc_id, s.k AS a, min(e.k) AS b FROM sums s JOIN sums e
    ON s.doc_id = e.doc_id AND e.k BETWEEN s.k AND s.k + 49 AND e.upto - s.upto + s.w >= 50 GROUP BY ALL
  UNION
  SELECT e.doc_id, max(s.k) AS a, e.k AS b FROM sums s JOIN sums e
    ON s.doc_id = e.doc_id AND s.k BETWEEN e.k - 49 AND e.k AND e.upto - s.upto + s.w >= 50 GROUP BY s.doc_id, e.doc_id, e.k
), contents AS (
  SELECT p.doc_id, p.a, p.b, string_agg(w.x, chr(10) ORDER BY w.k) AS content
  FROM spans p JOIN words w ON p.doc_id = w.doc_id AND w.k BETWEEN p.a AND p.b GROUP BY ALL
), firsts AS (
  SELECT *, first_value(struct_pack(d := doc_id, a := a)) OVER (PARTITION BY content ORDER BY doc_id, a) AS f FROM contents
), met AS (
  SELECT doc_id, a, b, f.d AS source FROM firsts WHERE f.d < doc_id OR (f.d = doc_id AND f.a < a)
), raws AS (
  SELECT m.doc_id, m.source, s.r AS a, e.r AS b FROM met m
  JOIN words s ON s.doc_id = m.doc_id AND s.k = m.a JOIN words e ON e.doc_id = m.doc_id AND e.k = m.b
), gone AS (
  SELECT DISTINCT l.doc_id, l.r FROM lines l JOIN raws g ON l.doc_id = g.doc_id AND l.r BETWEEN g.a AND g.b
), left_over AS (
  SELECT l.doc_id, coalesce(string_agg(CASE WHEN g.r IS NULL THEN l.raw END, chr(10) ORDER BY l.r), '') AS kept,
         count(*) FILTER (l.x <> '') AS n_lines, count(*) FILTER (l.x <> '' AND g.r IS NOT NULL) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.r = g.r GROUP BY l.doc_id
), origin AS (
  SELECT doc_id, string_agg(source::VARCHAR, ',' ORDER BY source) AS sources
  FROM (SELECT DISTINCT doc_id, source FROM raws) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE o.kept END AS text, o.n_lines, o.n_removed,
       coalesce(s.sources, '') AS sources
FROM documents d JOIN left_over o USING (doc_id) LEFT JOIN origin s USING (doc_id)
"""

_OP5 = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS x FROM documents
), parts AS (
  SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM texts
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM parts
), windows AS (
  SELECT doc_id, k, CASE WHEN lead(k, 7) OVER s IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER s,
    lead(word, 2) OVER s, lead(word, 3) OVER s, lead(word, 4) OVER s, lead(word, 5) OVER s, lead(word, 6) OVER s,
    lead(word, 7) OVER s) END AS win
  FROM words WINDOW s AS (PARTITION BY doc_id ORDER BY k)
), often AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows WHERE win IS NOT NULL)
  WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(lead_k - k, 8))) AS n FROM (
    SELECT doc_id, k, lead(k) OVER (PARTITION BY doc_id ORDER BY k) AS lead_k FROM often) GROUP BY doc_id
), stutter AS (
  SELECT doc_id, count(*) FILTER (word = before) AS n FROM (
    SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM words) GROUP BY doc_id
), counts AS (
  SELECT p.doc_id, p.x, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(s.n, 0) AS n_stutter
  FROM parts p LEFT JOIN covered c USING (doc_id) LEFT JOIN stutter s USING (doc_id)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 10 > n_words * 3 OR word_chars > n_words * 15 OR word_chars < n_words * 2
    OR n_dup_lines * 10 > n_lines * 4 OR n_stutter * 10 > n_words * 4
    OR length(regexp_replace(x, '[^\p{{Lu}}]+', '', 'g')) * 2 > length(regexp_replace(x, '[^\p{{L}}]+', '', 'g'))) AS kept
FROM based
"""

_OP13 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _op11(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other; a floor of a quotient, as ``//`` cuts towards zero."""
    parts = [f"""
WITH ints AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, v AS c FROM ints
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id)) <= {clusters}
)"""]
    gap = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        parts.append(f""", a{i} AS MATERIALIZED (
  SELECT vec_id, v, k, d FROM (SELECT vec_id, v, k, {gap} AS d FROM ints, c{i})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1
)""")
        if i < rounds:
            parts.append(f""", c{i + 1} AS MATERIALIZED (
  SELECT o.k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY p) AS c FROM (
      SELECT k, p, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY k, p) GROUP BY k) m USING (k)
)""")
    return "".join(parts) + f"""
SELECT a.vec_id, a.k::INT AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (k)
"""


def _op12(fan: int = 16, folds: int = 8) -> str:
    """So many folds per tree, each of them idle once one node is left; the checksum of an id bit by bit."""
    value = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(
        [value("doc_id"), value("source"), value("lang"), value("n_chars"), value(text)]) + ")"
    bits = "list_transform(range(8 * length(doc_id::VARCHAR)), lambda i: CASE WHEN i % 8 = 0 " \
           "THEN ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT ELSE 0::BIGINT END)"
    step = "lambda c, e: CASE WHEN xor(c, e) & 1 = 1 THEN xor(xor(c, e) >> 1, 3988292384) ELSE xor(c, e) >> 1 END"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), {step}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
WITH texts AS (
  SELECT *, CASE WHEN {crc} % 5 = 0 THEN {lower} ELSE text END AS seen FROM documents
), leaves AS MATERIALIZED (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('seen')} AS f0,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r FROM texts
), n0 AS (SELECT source, r AS p, leaf AS h FROM leaves)"""]

    def tree(name: str, by: str) -> None:
        for k in range(folds):
            parts.append(f""", {name}s{k} AS MATERIALIZED (
  SELECT {by}, p, h, count(*) OVER (PARTITION BY {by}) AS many,
         coalesce(string_agg(h, '') OVER (PARTITION BY {by}, p // {fan} ORDER BY p
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY {by}, p // {fan} ORDER BY p
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}
), {name}{k + 1} AS (
  SELECT {by}, p // {fan} AS p, CASE WHEN any_value(many) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h
  FROM {name}s{k} GROUP BY {by}, p // {fan}
)""")

    def climb(name: str, by: str, start: str, at: str) -> str:
        for k in range(folds):
            now = f"{name}x{k}"
            parts.append(f""", {now} AS (
  SELECT x.* EXCLUDE (f, proof), CASE WHEN t.many > 1 THEN sha256(t.l || x.f || t.r) ELSE x.f END AS f,
         CASE WHEN t.many > 1 THEN x.proof || t.l || t.r ELSE x.proof END AS proof
  FROM {start} x JOIN {name}s{k} t ON t.{by} IS NOT DISTINCT FROM x.{by} AND t.p = x.{at} // {fan ** k}
)""")
            start = now
        return start

    tree("n", "source")
    parts.append(f""", subroots AS MATERIALIZED (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, 0 AS one FROM n{folds}
), m0 AS (SELECT one, g AS p, subroot AS h FROM subroots)""")
    tree("m", "one")
    parts.append(", y AS (SELECT doc_id, source, r, leaf, f0 AS f, '' AS proof FROM leaves)")
    last = climb("n", "source", "y", "r")
    parts.append(f", z AS (SELECT x.*, s.subroot, s.g, s.one FROM {last} x JOIN subroots s ON s.source IS NOT DISTINCT FROM x.source)")
    last = climb("m", "one", "z", "g")
    return "".join(parts) + f"""
SELECT x.doc_id, x.leaf, x.subroot, t.h AS root, sha256(x.proof) AS proof_sha256, x.f AS folded_root, x.f = t.h AS verified
FROM {last} x, m{folds} t
"""


ORACLES = {
    "op2_line_dedup": _OP2, "op5_quality_rules": _OP5, "op11_centroids": _op11(), "op12_merkle_manifest": _op12(),
    "op13_exact_dedup": _OP13,
}
