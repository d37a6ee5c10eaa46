"""DuckDB SQL of the document queries that SQL can express over whole tables."""

from __future__ import annotations

from hopscan.llm.quality_rules import ERROR, GRID, LEAST_GAIN, RISK

_WORDS = r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_RULES = {
    "symbols_per_word": "n_symbols", "repeated_share": "n_repeat_words", "copied_lines_per_word": "n_dup_lines",
    "chars_per_word": "word_chars",
}
_CUTOFFS = ", ".join(f"('{r}', {i}, {c}e0)" for r, cs in GRID.items() for i, c in enumerate(cs))
_FIGURE = "CASE rule " + " ".join(f"WHEN '{r}' THEN CAST({c} AS DOUBLE) / greatest(n_words, 1)" for r, c in _RULES.items()) + " END"
_RATE = RISK / len(GRID)

QUALITY = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS.format(t="t")} AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS gram FROM w, unnest(range(1, len(ws) - 3)) r(i)),
again AS (SELECT doc_id, gram FROM g GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM g JOIN again USING (doc_id, gram), unnest(range(0, 5)) s(o) GROUP BY 1),
f AS (SELECT w.doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words,
        length(translate(t, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)), '')) AS word_chars,
        length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
l AS (SELECT doc_id, min(coalesce(quality, 0) = 1 AND coalesce(toxic, 0) = 0) AS good, max(coalesce(quality, 0) = 0) AS bad FROM labels GROUP BY 1),
c AS (SELECT * FROM (VALUES {_CUTOFFS}) v(rule, step, cutoff)),
k AS (SELECT lang, rule, step, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (bad) AS n_bad,
        count(*) FILTER (good AND {_FIGURE} > cutoff) AS k, count(*) FILTER (bad AND {_FIGURE} > cutoff) AS hits
      FROM b JOIN l USING (doc_id), c WHERE NOT base_failed GROUP BY ALL),
p AS (SELECT *, CASE WHEN k >= n * {_RATE} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
        lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE}) + (n - i) * ln(1 - {_RATE})))) END AS tail,
        hits / greatest(n_bad, 1) - k / greatest(n, 1) AS gain, count(DISTINCT concat(lang IS NULL, coalesce(lang, ''))) OVER () AS strata FROM k),
o AS (SELECT *, min(CASE WHEN tail > {ERROR} / (strata * {len(GRID)}) THEN step END) OVER (PARTITION BY lang, rule) AS stop FROM p),
held AS (SELECT lang, rule, arg_max(cutoff, (gain, -step)) AS cutoff FROM o WHERE (stop IS NULL OR step < stop) AND gain >= {LEAST_GAIN} GROUP BY 1, 2),
bad AS (SELECT DISTINCT b.doc_id FROM b JOIN held h ON b.lang IS NOT DISTINCT FROM h.lang WHERE {_FIGURE} > h.cutoff)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM b LEFT JOIN bad ON b.doc_id = bad.doc_id
"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(t=_FOLDED)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS shingle FROM w, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) r(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, k.b FROM reach r JOIN both_ways k ON r.other = k.a),
m AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""

_OF_TEXT = _WORDS.format(t="coalesce(text, '')")
#: The table of CRC-32 by its polynomial, and the CRC of the bytes that a column has as hexadecimal digits.
_CRC_TABLE = """digit(i, k, c) AS (
  SELECT i, 0, i FROM range(0, 256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM digit WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM digit WHERE k = 8)"""


def _crc(digits: str) -> str:
    return f"""xor(4294967295, list_reduce(list_transform(range(1, len({digits}), 2), lambda i: CAST(concat('0x', substr({digits}, i, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295))"""


RUNS = f"""
WITH RECURSIVE {_CRC_TABLE},
w AS (SELECT doc_id, {_OF_TEXT} AS ws, hex(encode(CAST(doc_id AS VARCHAR))) AS x FROM documents),
h AS (SELECT doc_id, ws, len(ws) AS n, {_crc('x')} AS h FROM w, crc_table),
a AS (SELECT *, (h // 10) % greatest(n, 1) AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
u AS MATERIALIZED (SELECT doc_id, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM p, unnest(range(0, n)) r(i)),
e AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM u x JOIN u y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i WHERE 3 * (y.i - x.i) <= x.n),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM e),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, part HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, i FROM runs, unnest(range(start + period, start + length)) r(i)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM u ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
l AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed FROM runs GROUP BY 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w d LEFT JOIN l USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN k USING (doc_id)
"""

VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
held AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
bytes AS (SELECT *, hex(encode(concat(doc_id, ':', run))) AS x FROM held),
hashed AS (SELECT run, n, {_crc('x')} AS h FROM bytes, crc_table),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
less AS (SELECT DISTINCT word, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS short, i FROM v, unnest(range(1, length(word) + 1)) r(i)),
pairs AS (
  SELECT DISTINCT a.word, b.word AS near FROM less a JOIN less b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.short FROM less a JOIN v ON v.word = a.short UNION SELECT a.short, a.word FROM less a JOIN v ON v.word = a.short),
best AS (SELECT p.word, count(*) AS n_near, arg_min(p.near, (-b.n, p.near)) AS near FROM pairs p JOIN v b ON b.word = p.near GROUP BY 1),
form AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * v.n THEN near END AS form, CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n
  FROM v LEFT JOIN best USING (word) LEFT JOIN v b ON b.word = near),
way(word, place) AS (SELECT word, word FROM form UNION ALL SELECT w.word, f.form FROM way w JOIN form f ON f.word = w.place WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.place AS root, f.n, f.n_near, f.form_n FROM form f JOIN way w USING (word) JOIN form e ON e.word = w.place WHERE e.form IS NULL
"""

WINDOWS = f"""
WITH w AS (SELECT doc_id, {_OF_TEXT} AS ws FROM documents),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 12) AS gram FROM w, unnest(range(1, len(ws) - 11)) r(i)),
f AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY 1),
hit AS (SELECT DISTINCT doc_id, i + o AS p FROM g JOIN f USING (gram), unnest(range(0, 13)) s(o) WHERE least < doc_id),
u AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) r(p)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM u ANTI JOIN hit USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

SQL: dict[str, str] = {
    "op4_quality_rules": QUALITY, "op6_near_dedup": NEAR, "op7_top_k": TOP_K, "op11_periodic_runs": RUNS, "op12_spelling": VARIANTS,
    "op13_block_dedup": WINDOWS,
}
