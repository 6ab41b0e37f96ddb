"""DuckDB SQL of the operators that SQL can express, over whole tables.

The others hash with XXH64 or CRC-32, train, tokenise or parse markup; ``tests/llm`` compares them with plain Python.
"""

from __future__ import annotations

from wardstat.llm.quality import ALLOWED, LEAST_WORDS, LINE_LIMIT, NGRAM_LIMITS

WARC = """WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
f AS (SELECT h, MIN(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN p.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id > f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h"""


def _quality() -> str:
    lengths = [3, *NGRAM_LIMITS]

    def gram(n: int) -> str:
        words = ", ".join(["word", *(f"LEAD(word, {k}) OVER o" for k in range(1, n))])
        return f"CASE WHEN LEAD(word, {n - 1}) OVER o IS NOT NULL THEN concat_ws(' ', {words}) END AS g{n}"

    grams = ", ".join(gram(n) for n in lengths)
    found = ", ".join(f"CASE WHEN g{n} IS NOT NULL AND COUNT(*) OVER (PARTITION BY doc_id, g{n}) > 1 THEN 1 ELSE 0 END AS r{n}" for n in lengths)
    inside = ", ".join(f"MAX(r{n}) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS i{n}" for n in lengths)
    chars = ", ".join(f"SUM(i{n} * size) AS c{n}" for n in NGRAM_LIMITS)
    shares = ", ".join(f"COALESCE(c{n}, 0) / CAST(greatest(word_chars, 1) AS DOUBLE) AS coverage_{n}" for n in NGRAM_LIMITS)
    within = " AND ".join(f"COALESCE(c{n}, 0) <= CAST({x} AS DOUBLE) * word_chars + {ALLOWED}" for n, x in NGRAM_LIMITS.items())
    blank = r"\x20\x09-\x0D"
    return rf"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(t, '[^{blank}]+') AS ws FROM d)),
g AS (SELECT doc_id, pos, length(word) AS size, {grams} FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, size, {found} FROM g),
i AS (SELECT doc_id, size, {inside} FROM r),
n AS (SELECT doc_id, COUNT(*) AS n_words, SUM(size) AS word_chars, SUM(i3) AS n_repeat_words, {chars} FROM i GROUP BY doc_id),
l AS (SELECT doc_id, length(regexp_replace(line, '[{blank}]', '', 'g')) AS size,
    ROW_NUMBER() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d))),
m AS (SELECT doc_id, COUNT(*) FILTER (size > 0 AND nth > 1) AS n_dup_lines, COALESCE(SUM(size) FILTER (nth > 1), 0) AS dup_chars FROM l GROUP BY doc_id),
a AS (SELECT d.doc_id, CAST(COALESCE(n_words, 0) AS BIGINT) AS n_words, CAST(COALESCE(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(COALESCE(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, dup_chars, {", ".join(f"c{n}" for n in NGRAM_LIMITS)}
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)),
s AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    dup_chars / CAST(greatest(word_chars, 1) AS DOUBLE) AS line_coverage, {shares} FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, line_coverage,
  {", ".join(f"coverage_{n}" for n in NGRAM_LIMITS)},
  NOT base_failed AND dup_chars <= CAST({LINE_LIMIT} AS DOUBLE) * word_chars + {ALLOWED} AND {within} AS kept
FROM s"""


DECONTAMINATION = r"""WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(COALESCE(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(COALESCE(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') FROM benchmark
),
shingles AS (
  SELECT DISTINCT side, id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS i FROM words)
),
sizes AS (SELECT id, COUNT(*) AS n FROM shingles WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, COUNT(*) / CAST(ANY_VALUE(n) AS DOUBLE) AS containment
FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' JOIN sizes ON sizes.id = i.id
GROUP BY d.id, i.id HAVING COUNT(*) >= 0.8 * ANY_VALUE(n)"""


HARD_NEGATIVES = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10"""

ORACLES: dict[str, str] = {
    "op1_warc": WARC,
    "op6_quality_rules": _quality(),
    "op7_decontamination": DECONTAMINATION,
    "op11_hard_negatives": HARD_NEGATIVES,
}
