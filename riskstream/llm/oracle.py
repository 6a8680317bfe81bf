"""The same results as DuckDB SQL, where SQL can state them."""

from __future__ import annotations

_PLAIN = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower_words(table: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({table}.text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        f"'abcdefghijklmnopqrstuvwxyz'), '{_ALNUM}')"
    )


_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_lower_words("documents")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_lower_words("benchmark")} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN lengths ON len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM doc_windows JOIN item_windows USING (win, n)),
covered AS (
  SELECT doc_id, COUNT(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
found AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_lower_words("documents")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS k FROM shingles x JOIN shingles y USING (s)
  WHERE x.doc_id <> y.doc_id GROUP BY a, b),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 10 * k >= 8 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id, doc_id AS c FROM d UNION SELECT links.b AS doc_id, reach.c FROM reach JOIN links ON links.a = reach.doc_id),
classes AS (SELECT doc_id, MIN(c) AS class_id FROM reach GROUP BY doc_id),
degrees AS (SELECT a AS doc_id, COUNT(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n, 0) AS n_shingles
FROM classes LEFT JOIN degrees USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

_SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_PLAIN}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
owners AS (SELECT win, MIN(doc_id) AS least FROM windows GROUP BY win),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN owners USING (win) WHERE doc_id > least),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT places.doc_id, COUNT(*) AS n, string_agg(word, ' ' ORDER BY places.p) AS body
  FROM places LEFT JOIN removed ON removed.doc_id = places.doc_id AND removed.p = places.p
  WHERE removed.p IS NULL GROUP BY places.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * word_chars",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
}


def _shrunk(rule: str) -> str:
    """A host's failure rate, shrunk with a beta prior fitted by moments over all hosts."""
    within = f"mean_{rule} * (1 - mean_{rule})"
    beyond = f"(var_{rule} - {within} * unit)"
    weight = f"CASE WHEN {beyond} > 0 THEN least(greatest({within} / {beyond} - 1, 2.0), 10000.0) ELSE 10000.0 END"
    return f"({rule} + mean_{rule} * ({weight})) / (n_docs + ({weight}))"


_HOST_RULES = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_PLAIN}') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, run FROM runs GROUP BY doc_id, run HAVING COUNT(*) > 1),
repeats AS (
  SELECT doc_id, COUNT(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM runs JOIN twice USING (doc_id, run)) GROUP BY doc_id),
measures AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, {", ".join(f"{test} AS {rule}" for rule, test in _RULES.items())} FROM measures),
hosts AS (
  SELECT source, COUNT(*) AS n_docs, {", ".join(f"count_if({rule}) AS {rule}" for rule in _RULES)}
  FROM judged WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT avg(1 / n_docs) AS unit, {", ".join(f"avg({rule} / n_docs) AS mean_{rule}, coalesce(var_samp({rule} / n_docs), 0) AS var_{rule}" for rule in _RULES)}
  FROM hosts),
bad AS (SELECT source FROM hosts, moments WHERE greatest({", ".join(_shrunk(rule) for rule in _RULES)}) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
       NOT (short OR repetitive) AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM judged"""

_RANKED = f"""
WITH d AS (SELECT doc_id, unnest({_lower_words("documents")}) AS term FROM documents),
q AS (
  SELECT item_id, term, COUNT(*) AS k
  FROM (SELECT item_id, unnest({_lower_words("benchmark")}) AS term FROM benchmark) GROUP BY item_id, term),
lengths AS (SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n FROM d GROUP BY doc_id),
whole AS (SELECT CAST(COUNT(*) AS BIGINT) AS N_, CAST(SUM(n) AS BIGINT) AS L_ FROM lengths),
counts AS (
  SELECT doc_id, term, CAST(COUNT(*) AS BIGINT) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * N_ + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
  FROM counts, whole GROUP BY term, N_),
scores AS (
  SELECT item_id, doc_id,
         CAST(SUM(k * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * N_) // L_)))) AS BIGINT) AS score
  FROM q JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""

STATEMENTS: dict[str, str] = {
    "op2_decontamination": _DECONTAMINATION,
    "op6_jaccard_join": _JACCARD,
    "op7_substring_dedup": _SUBSTRINGS,
    "op8_host_rules": _HOST_RULES,
    "op11_ranked_search": _RANKED,
    "op13_hard_negatives": _NEGATIVES,
}
