"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from aislecast.llm.curriculum import CAP, SCHEDULES, SHARE, WEIGHTS
from aislecast.llm.divergence_rules import CLASSES, Rules

WORD = r"[^\x20\x09-\x0D]+"


def _case(values: list[float], index: str) -> str:
    return f"list_value({', '.join(f'{v!r}::DOUBLE' for v in values)})[({index}) % {len(values)} + 1]"


def mix_sql() -> str:
    a, b = (_case([s[i] for s in SCHEDULES], "sid") for i in (0, 1))
    reached = f"(({a} + {b}) / 2.0 * start::DOUBLE / target)"
    return f"""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
             md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
    totals AS (
      SELECT *, {_case(list(WEIGHTS), "sid")} AS weight FROM (
        SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sized GROUP BY source)),
    levels AS (
      SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER () - {CAP}::DOUBLE * coalesce(sum(source_size) OVER (
          ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY source_size / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
      FROM totals),
    targets AS (
      SELECT source, sid, source_size, least({CAP}::DOUBLE * source_size, max(lv) OVER () * weight) AS target FROM levels),
    streamed AS (
      SELECT s.doc_id, s.size, t.source_size, t.target, t.sid, s.k,
             coalesce(sum(s.size) OVER (PARTITION BY t.sid ORDER BY s.k, s.doc_id, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    taken AS (
      SELECT *, CASE WHEN size > 0 THEN epochs * size ELSE 0 END + greatest(0, least(size,
          floor(target - epochs * source_size + 0.5)::BIGINT - start)) AS taken FROM streamed)
    SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
           CASE WHEN taken > 0 THEN 2.0 * {reached} / ({a} + sqrt({a} * {a} + 2.0 * ({b} - {a}) * {reached})) END AS position
    FROM taken"""


def _re(chars: str) -> str:
    return "[" + chars.replace(r"\"", '"').replace("'", "''") + "]+"


def rules_sql(rules: Rules | None = None) -> str:
    r = rules or Rules()
    lower = "lower(coalesce(text, ''))"
    counts = ", ".join(
        f"(length(t) - length(regexp_replace(t, '{_re(chars)}', '', 'g')))::BIGINT AS c{k}"
        for k, chars in enumerate(CLASSES.values())
    )
    n = len(CLASSES)
    others = " - ".join(["length(t)", *(f"c{k}" for k in range(n))])
    term = lambda p, q: (
        f"(CASE WHEN {p} > 0 THEN {p} * log2(2.0 * {p} / ({p} + {q})) ELSE 0 END"
        f" + CASE WHEN {q} > 0 THEN {q} * log2(2.0 * {q} / ({p} + {q})) ELSE 0 END)"
    )
    share = lambda k: f"(b.c{k} / greatest(length(b.t), 1)::DOUBLE)"
    prose = "" if r.max_prose_distance is None else f" OR coalesce(y.d > {r.max_prose_distance}, false)"
    class_terms = " + ".join(term(share(k), f"l.q{k}") for k in range(n + 1))
    return f"""
    WITH rows_ AS (SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {lower} AS lt FROM documents),
    grams AS (SELECT id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
              FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM rows_)),
    twice AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, a, b, c) AS n FROM grams) WHERE n > 1),
    repeated AS (SELECT id, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) x(d) GROUP BY id),
    lines AS (SELECT id, sum(n - 1) AS n FROM (
                SELECT id, line, count(*) AS n FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM rows_)
                WHERE regexp_matches(line, '{WORD}') GROUP BY id, line) GROUP BY id),
    classed AS (SELECT *, {counts} FROM rows_),
    base AS (
      SELECT c.*, ({others})::BIGINT AS c{n}, len(w)::BIGINT AS n_words, (length(t) - c3)::BIGINT AS word_chars,
             c4 AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM classed c LEFT JOIN lines l USING (id) LEFT JOIN repeated r USING (id)),
    langs AS (
      SELECT lang, {", ".join(f"sum(c{k})::DOUBLE / sum(length(t)) AS q{k}" for k in range(n + 1))}, sum(length(t)) AS chars
      FROM base WHERE lang IS NOT NULL GROUP BY lang HAVING sum(length(t)) > 0 ORDER BY chars DESC, lang LIMIT {r.languages}),
    ranked AS (
      SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rn
      FROM (SELECT lang, unnest(regexp_extract_all(lt, '{WORD}')) AS word FROM rows_ WHERE lang IS NOT NULL)
      GROUP BY lang, word),
    spoken AS (SELECT lang, sum(n) AS total FROM ranked WHERE rn <= {r.common} GROUP BY lang
               ORDER BY total DESC, lang LIMIT {r.languages}),
    refs AS (SELECT lang, word, n::DOUBLE / total AS q FROM ranked JOIN spoken USING (lang) WHERE rn <= {r.common}),
    seen AS (
      SELECT id, word, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lt, '{WORD}')) AS word FROM rows_)
      WHERE word IN (SELECT word FROM refs) GROUP BY id, word),
    found AS (SELECT id, sum(n) AS n FROM seen GROUP BY id),
    shared AS (SELECT s.id, f.lang, f.word, f.q, s.n / sum(s.n) OVER (PARTITION BY s.id, f.lang)::DOUBLE AS p
               FROM seen s JOIN refs f USING (word)),
    word_far AS (
      SELECT id, min(d) AS d FROM (
        SELECT id, lang, sqrt(greatest(0, (sum({term("p", "q")}) + 1.0 - sum(q)) / 2)) AS d FROM shared GROUP BY id, lang)
      JOIN found USING (id) WHERE n >= {r.common_words} GROUP BY id),
    every AS (SELECT lang, sum(n)::DOUBLE AS every FROM ranked GROUP BY lang),
    tongues AS (
      SELECT *, sqrt((common + CASE WHEN other > 0 THEN other * log2(2 * other / (1 + other)) ELSE 0 END + log2(2 / (1 + other))) / 2) AS none
      FROM (SELECT lang, total / every AS common, greatest(0, 1.0 - total / every) AS other FROM spoken JOIN every USING (lang))),
    spread AS (
      SELECT id, lang, sum({term("p", "q")}) AS terms, sum(p) AS own, sum(q) AS seen FROM (
        SELECT s.id, f.lang, s.n / b.n_words::DOUBLE AS p, f.q * t.common AS q
        FROM seen s JOIN base b USING (id) JOIN refs f USING (word) JOIN tongues t ON t.lang = f.lang) GROUP BY id, lang),
    prose_far AS (
      SELECT id, min(sqrt(greatest(0, (terms + (common - seen) + {term("rest", "other")}) / 2)) / none) AS d FROM (
        SELECT b.id, t.common, t.other, t.none, coalesce(s.terms, 0) AS terms, coalesce(s.seen, 0) AS seen,
               greatest(0, 1.0 - coalesce(s.own, 0)) AS rest
        FROM base b CROSS JOIN tongues t LEFT JOIN spread s ON s.id = b.id AND s.lang = t.lang WHERE b.n_words > 0) GROUP BY id),
    class_far AS (SELECT b.id, min(sqrt(greatest(0, ({class_terms}) / 2))) AS d FROM base b, langs l GROUP BY b.id),
    judged AS (
      SELECT b.*, (n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words) AS base_failed,
             n_words >= {r.divergence_words} AND (coalesce(c.d > {r.max_class_distance}, false)
               OR coalesce(x.d > {r.max_word_distance}, false){prose}) AS far
      FROM base b LEFT JOIN class_far c USING (id) LEFT JOIN word_far x USING (id) LEFT JOIN prose_far y USING (id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT far AS kept FROM judged"""


SQL = {"op2_mix": mix_sql(), "op6_quality_rules": rules_sql()}

SQL["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
"""

SQL["op11_ngram_join"] = r"""
WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT k, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM rows_),
sizes AS (SELECT k, count(*) AS n FROM shingles GROUP BY k),
shared AS (SELECT a.k AS x, b.k AS y, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.k <> b.k GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.k = x JOIN sizes b ON b.k = y WHERE 100 * m >= 85 * (a.n + b.n - m)),
reached AS (SELECT k AS a, k AS c FROM rows_ UNION SELECT a, y FROM reached JOIN links ON c = x)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id,
  (SELECT count(*) FROM links WHERE x = r.k) AS n_links
FROM rows_ r LEFT JOIN sizes s ON s.k = r.k JOIN reached ON a = r.k JOIN rows_ o ON o.k = c GROUP BY r.k, r.doc_id
"""
