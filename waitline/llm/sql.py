"""SQL of those queries that SQL can express."""

from __future__ import annotations

from waitline.llm import divergence, filter_audit, line_dedup, mixing, quality
from waitline.llm.queries import DECAY_EVERY

WORD = r"[^\x20\x09-\x0D]+"


def _mixing() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    most = mixing.MOST_REPEATS
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, {most} * CAST(sum(size) AS BIGINT) AS most,
    [{weights}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}]
      AS weight
  FROM docs GROUP BY source
), rounds(n, share) AS (
  SELECT 0, sum(source_size)::DOUBLE / sum(weight)::DOUBLE FROM sources
  UNION
  SELECT n + 1, (SELECT (sum(source_size)
      - coalesce(sum(most) FILTER (WHERE most < rounds.share * weight), 0))::DOUBLE
      / sum(weight) FILTER (WHERE most >= rounds.share * weight)::DOUBLE FROM sources)
  FROM rounds WHERE n < 100 AND EXISTS (SELECT 1 FROM sources WHERE most < rounds.share * weight)
), targets AS (
  SELECT source, source_size,
    least(most::DOUBLE, (SELECT max(share) FROM rounds) * weight) AS target
  FROM sources
), rates AS (
  SELECT *, CASE WHEN source_size > 0
    THEN least(target / source_size, {most}.0::DOUBLE) ELSE 0 END AS rate
  FROM targets
), coins AS (
  SELECT d.*, r.source_size, r.target, floor(r.rate)::BIGINT AS whole, r.rate - floor(r.rate) AS part,
    ('0x' || substr(md5('{mixing.SEED}:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496::DOUBLE
      AS coin
  FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (whole + (coin < part)::BIGINT))::BIGINT AS taken,
  (whole + (coin < part)::BIGINT)::BIGINT AS copies
FROM coins"""


def _line_dedup() -> str:
    lines = line_dedup.LINES
    window = " || chr(10) || ".join(f"ls[p + {n + 1}]" for n in range(lines))
    covers = ", ".join(f"({n})" for n in range(lines))
    return f"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), starts AS (
  SELECT doc_id, ls, unnest(range(0, len(ls) - {lines - 1})) AS p FROM split
), windows AS (
  SELECT doc_id, p, {window} AS three FROM starts
), numbered AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY three ORDER BY doc_id, p) AS times FROM windows
), covered AS (
  SELECT DISTINCT doc_id, p + k AS line FROM numbered, (VALUES {covers}) v(k) WHERE times > 1
), each AS (
  SELECT doc_id, unnest(ls) AS line_text, unnest(range(0, len(ls))) AS line FROM split
), cleaned AS (
  SELECT e.doc_id, count(*) AS n_lines, count(c.line) AS n_removed,
    coalesce(string_agg(line_text, chr(10) ORDER BY e.line) FILTER (WHERE c.line IS NULL), '')
      AS clean
  FROM each e LEFT JOIN covered c USING (doc_id, line) GROUP BY e.doc_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN s.text IS NULL THEN NULL ELSE clean END AS text
FROM split s LEFT JOIN cleaned USING (doc_id)"""


def _quality() -> str:
    risk = quality.Risk()
    limit = risk.false_rejection / len(quality.RULES)
    tests = [(rule, cutoff) for rule in quality.RULES for cutoff in rule.cutoffs]
    cutoffs = ", ".join(
        f"min(cutoff) FILTER (WHERE rule = '{rule.name}' AND unbroken) AS cut_{rule.name}"
        for rule in quality.RULES
    )
    rejected = " OR ".join(
        f"coalesce(100 * {rule.part} > cut_{rule.name} * {rule.whole}, false)" for rule in quality.RULES
    )
    structs = ", ".join(
        f"{{'rule': '{rule.name}', 'cutoff': {cutoff}, 'errors': "
        f"count(*) FILTER (WHERE 100 * {rule.part} > {cutoff} * {rule.whole})}}"
        for rule, cutoff in tests
    )
    return f"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents
), three AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS w3,
    unnest(range(1, len(ws) - 1)) AS i
  FROM docs
), twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w3) AS times FROM three
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k)
  WHERE times > 1 GROUP BY doc_id
), measured AS (
  SELECT doc_id, lang, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN repeated USING (doc_id)
), based AS (
  SELECT *, n_words < {quality.LEAST_WORDS}
    OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM measured
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), counted AS (
  SELECT lang, count(*) AS trials, unnest([{structs}]) AS test
  FROM based JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY lang
), tested AS (
  SELECT lang, trials, test.rule AS rule, test.cutoff AS cutoff, test.errors AS errors,
    dense_rank() OVER (ORDER BY lang) + dense_rank() OVER (ORDER BY lang DESC) - 1 AS strata
  FROM counted
), passed AS (
  SELECT *, errors < trials * {limit!r} AND list_sum(list_transform(
    range(0, errors + 1), lambda j: exp(lgamma(trials + 1.0) - lgamma(j + 1.0)
      - lgamma(trials - j + 1.0) + j * ln({limit!r}) + (trials - j) * ln(1 - {limit!r}))))
    <= {risk.error!r} / (strata * {len(quality.RULES)}) AS passes
  FROM tested
), certified AS (
  SELECT *, bool_and(passes) OVER (PARTITION BY lang, rule ORDER BY cutoff DESC) AS unbroken
  FROM passed
), cutoffs AS (
  SELECT lang, {cutoffs} FROM certified GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
  NOT base_failed AND NOT ({rejected}) AS kept
FROM based b LEFT JOIN cutoffs c ON b.lang IS NOT DISTINCT FROM c.lang"""


def _fixity() -> str:
    return f"""
WITH records AS (
  SELECT page_id, html, 'pages-' || (page_id // 1000) AS file,
    strlen('WARC/1.1..WARC-Type: resource..WARC-Record-ID: <urn:page:' || page_id
      || '>..WARC-Target-URI: ' || url || '..Content-Type: text/html..Content-Length: '
      || strlen(html) || '....') + strlen(html) + 4 AS length
  FROM pages
), placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM records
)
SELECT page_id, file, "offset", length::BIGINT AS length,
  CASE page_id % {DECAY_EVERY} WHEN 5 THEN 'missing' ELSE 'changed' END AS status
FROM placed
WHERE page_id % {DECAY_EVERY} = 5 OR (page_id % {DECAY_EVERY} = 3 AND contains(html, 'a'))"""


def _ngram_join() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS shingles
  FROM split
), each AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b, count(*) AS shared
  FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common WHERE 100 * shared >= 85 * (n_a + n_b - shared)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id FROM sets JOIN components USING (doc_id)"""


def _filter_audit() -> str:
    words = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"
    bits = {
        "A": f"len({words}) < {filter_audit.LEAST_WORDS}",
        "B": f"100 * len(list_distinct({words}))"
        f" < {filter_audit.LEAST_DISTINCT_PERCENT} * len({words})",
        "C": "100 * len(regexp_extract_all(coalesce(text, ''), '[A-Z]'))"
        f" > {filter_audit.MOST_CAPITALS_PERCENT} * length(coalesce(text, ''))",
        "D": f"regexp_matches(coalesce(text, ''), '[{filter_audit.SYMBOLS}]')",
        "E": "coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false)",
    }
    columns = ", ".join(f"{rule} AS {name.lower()}" for name, rule in bits.items())
    letters = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"
    fails = " ".join(f"WHEN '{name}' THEN {name.lower()}" for name in bits)
    n_fails = " + ".join(f"{name.lower()}::INT" for name in bits)
    return f"""
WITH RECURSIVE judged AS (
  SELECT doc_id, max((quality = 1)::INT) = 1 AS good, max((toxic = 1)::INT) = 1 AS toxic
  FROM labels GROUP BY doc_id
), docs AS (
  SELECT coalesce(lang, '') AS part, doc_id, {columns} FROM documents
), verdicts AS (
  SELECT docs.*, {n_fails} AS n_fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM docs LEFT JOIN judged USING (doc_id)
), orders(filter_order) AS (
  SELECT ''
  UNION ALL
  SELECT filter_order || letter FROM orders, {letters} AS l(letter)
  WHERE NOT contains(filter_order, letter)
), steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS letter
  FROM orders, generate_series(1, 5) AS s(step) WHERE length(filter_order) = 5
), classes AS (
  SELECT part, good, toxic, a, b, c, d, e, count(*) AS docs FROM verdicts GROUP BY ALL
), applied AS (
  SELECT part, filter_order, step, letter, docs, good, toxic,
    {n_fails} AS n_fails,
    CASE letter {fails} END AS fails,
    list_position([CASE filter_order[1] {fails} END, CASE filter_order[2] {fails} END,
      CASE filter_order[3] {fails} END, CASE filter_order[4] {fails} END,
      CASE filter_order[5] {fails} END], true) AS leaves
  FROM classes, steps
), counted AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(docs) FILTER (leaves IS NULL OR leaves > step), 0) AS kept,
    coalesce(sum(docs) FILTER (leaves = step), 0) AS removed,
    coalesce(sum(docs) FILTER (fails AND leaves < step), 0) AS redundant,
    coalesce(sum(docs) FILTER (fails AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(docs) FILTER (leaves = step AND good), 0) AS good_lost,
    coalesce(sum(docs) FILTER (leaves = step AND toxic), 0) AS toxic_lost
  FROM applied GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted"""


def _divergence() -> str:
    upper, lower = divergence.LETTERS.decode(), divergence.LETTERS.decode().lower()
    scale = f"{divergence.SCALE}::HUGEINT"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{upper}', '{lower}') AS folded
  FROM documents
), occurrences AS (
  SELECT n, lang, source,
    unnest(regexp_extract_all(folded, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term FROM occurrences GROUP BY lang, term
  HAVING count(DISTINCT n) >= {divergence.LEAST_DOCS}
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM occurrences JOIN kept USING (lang, term)
  GROUP BY ALL
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), totals AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source)
  GROUP BY ALL
), grid AS (
  SELECT t.lang, t.source, k.term, coalesce(c, 0) AS c,
    1 + {scale} * (coalesce(c, 0) + 1) // (n + v) AS p
  FROM totals t JOIN sizes USING (lang) JOIN kept k USING (lang)
    LEFT JOIN counts x ON t.lang = x.lang AND t.source = x.source AND k.term = x.term
), whole AS (
  SELECT lang, term, 1 + {scale} * (sum(c) + 1) // (sum(sum(c)) OVER (PARTITION BY lang)
    + count(*) OVER (PARTITION BY lang)) AS q
  FROM grid GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum((g.p - h.p) * (g.p - h.p) // h.p), 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN grid g ON g.lang = a.lang AND g.source = a.source
    LEFT JOIN grid h ON h.lang = b.lang AND h.source = b.source AND h.term = g.term
  GROUP BY ALL
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM grid JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (FROM pairs UNION ALL FROM terms)
QUALIFY part = 'pair' OR rank <= {divergence.MOST_TERMS}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": _mixing(),
        "op2_line_dedup": _line_dedup(),
        "op3_quality_rules": _quality(),
        "op6_warc_fixity": _fixity(),
        "op10_ngram_join": _ngram_join(),
        "op11_source_divergence": _divergence(),
        "op13_filter_audit": _filter_audit(),
    }
