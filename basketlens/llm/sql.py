"""DuckDB SQL that gives the rows of the operators' queries, written from their definitions."""

from __future__ import annotations

from basketlens.llm.divergence import AT_MOST, CLASSES, COMMON, LIMITS, PUNCTUATION
from basketlens.llm.mixing import BLOCK_BITS, DIGITS, TARGET
from basketlens.llm.perspectives import CLOSE, END, NARRATOR, OPEN, SEGMENT
from basketlens.llm.url_templates import PURITY, RULES, SHAPES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mixing(seed: int = 7) -> str:
    steps = 1 << DIGITS
    return f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS tokens,
         CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents
), s AS (SELECT source, sum(tokens) AS n FROM d GROUP BY source),
whole AS (SELECT sum(n) AS n, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS k FROM s),
p AS (SELECT s.source, s.n, s.n / whole.n AS p FROM s, whole WHERE s.n > 0),
a AS (SELECT range AS i, range / {steps}.0 AS alpha FROM range({steps + 1})),
e AS (
  SELECT i, ln(sum(pow(p, alpha))) - alpha * sum(pow(p, alpha) * ln(p)) / sum(pow(p, alpha)) AS entropy,
         max(pow(p, alpha - 1)) / sum(pow(p, alpha)) * {TARGET.budget} AS repeats
  FROM a, p GROUP BY i, alpha
), chosen AS (
  SELECT greatest(
    coalesce((SELECT max(i) FROM e, whole WHERE entropy >= {TARGET.entropy} * ln(k) - 1e-9), 0),
    coalesce((SELECT min(i) FROM e WHERE repeats <= {TARGET.repeats} + 1e-9), {steps})) / {steps}.0 AS alpha
), w AS (SELECT source, n, alpha, pow(p, alpha) AS w FROM p, chosen),
-- whole tokens by largest remainders; what is a number of whole passes but for rounding is these passes
q AS (
  SELECT source, w.n, CASE WHEN alpha = 1 THEN w.n * {TARGET.budget} ELSE w * (whole.n * {TARGET.budget} / (SELECT sum(w) FROM w)) END AS q
  FROM w, (SELECT CAST(n AS DOUBLE) AS n FROM whole) whole
), r AS (
  SELECT source, n, CASE WHEN m > 0 AND abs(q - m) <= 1e-9 * m THEN m ELSE round(q, 6) END AS q
  FROM (SELECT *, round(q / n) * n AS m FROM q)
), f AS (SELECT *, floor(q) AS base, row_number() OVER (ORDER BY q - floor(q) DESC, source NULLS FIRST) AS place FROM r),
b AS (
  SELECT f.source, f.n, CAST(base + CASE WHEN place <= floor(whole.n * {TARGET.budget} + 1e-6) - (SELECT sum(base) FROM f)
                             THEN 1 ELSE 0 END AS BIGINT) AS budget
  FROM f, whole
), o AS (
  SELECT d.*, b.n, CAST(coalesce(b.budget, 0) AS BIGINT) AS budget,
         coalesce(sum(tokens) OVER (PARTITION BY d.source ORDER BY key >> {60 - BLOCK_BITS}, key, doc_id, tokens
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
), t AS (
  SELECT *, CASE WHEN n IS NULL THEN 1 ELSE budget // n
                 + CASE WHEN budget % n > 0 AND start + tokens <= budget % n THEN 1 ELSE 0 END END AS times
  FROM o
)
SELECT doc_id, source, tokens, CAST(e.range AS BIGINT) AS epoch,
       CAST(e.range * coalesce(n, 0) + start AS BIGINT) AS position, budget
FROM (SELECT *, unnest(range(CAST(times AS BIGINT))) AS range FROM t) e
"""


def backoff_lm() -> str:
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (
  SELECT doc_id, i, ws[i] AS g1, CASE WHEN i > 1 THEN ws[i - 1] || ' ' || ws[i] END AS g2,
         CASE WHEN i > 2 THEN ws[i - 2] || ' ' || ws[i - 1] || ' ' || ws[i] END AS g3
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)
), o AS (
  SELECT doc_id, i,
         count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY doc_id, g1) AS o1,
         count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY doc_id, g2) AS o2,
         count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY doc_id, g3) AS o3,
         (SELECT count(*) FROM g) - count(*) OVER (PARTITION BY doc_id) AS rest
  FROM g
), c AS (
  SELECT *, lag(o1) OVER (PARTITION BY doc_id ORDER BY i) AS c1, lag(o2) OVER (PARTITION BY doc_id ORDER BY i) AS c2 FROM o
), s1 AS (SELECT *, ln(greatest(o1, 1)) - ln(rest + 1) AS s FROM c),
s2 AS (SELECT * REPLACE (CASE WHEN i < 2 THEN s WHEN o2 > 0 AND c1 > 0 THEN ln(o2) - ln(c1) ELSE s + ln(0.4) END AS s) FROM s1),
s3 AS (SELECT * REPLACE (CASE WHEN i < 3 THEN s WHEN o3 > 0 AND c2 > 0 THEN ln(o3) - ln(c2) ELSE s + ln(0.4) END AS s) FROM s2),
t AS (SELECT doc_id, sum(s) AS s FROM s3 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(s, 0.0), 4) AS log_score,
       round(s / nullif(len(ws), 0), 4) AS mean_log_score
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""


def perspectives() -> str:
    safe = f"replace({{}}, '{OPEN}', '< |')"
    speaker = safe.format("CASE WHEN length(role) > 0 THEN role ELSE 'unknown' END")
    return f"""
WITH m AS (
  SELECT conv_id, turn, {speaker} AS speaker, {safe.format("coalesce(text, '')")} AS text,
         CAST(coalesce(floor(turn / {SEGMENT}), 0) AS BIGINT) AS segment
  FROM conversations
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, segment ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM m
), s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> '{NARRATOR}'),
r AS (
  SELECT n.conv_id, perspective, segment, place // {SEGMENT} AS part, place, speaker = perspective AS own,
         '{OPEN}' || CASE WHEN speaker = '{NARRATOR}' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                     ELSE 'user name=' || speaker END || '{CLOSE}' || chr(10) AS head,
         text || '{END}' AS body
  FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id
), q AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, segment, part
                     ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begin
  FROM r
)
SELECT conv_id, perspective, segment, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY place) AS rendered,
       coalesce(string_agg(begin || ':' || (begin + length(body)), ',' ORDER BY place) FILTER (own), '') AS mask
FROM q GROUP BY conv_id, perspective, segment, part
"""


def url_templates() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rules = sorted(RULES, key=lambda r: -len(r[1]))

    def fits(rule: str) -> str:
        host, _, path = rule.partition("/")
        return f"(g.host = '{host}' OR ends_with(g.host, '.{host}')) AND starts_with(path, '/{path}')"

    def chosen(values: list[str]) -> str:
        return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{v}'" for (_, r), v in zip(rules, values)) + " END"

    shape = "CASE " + " ".join(f"WHEN regexp_matches(x, '{p}') THEN '{s}'" for p, s in SHAPES) + " ELSE x END"
    return f"""
WITH RECURSIVE u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{alphabet}', '{alphabet.lower()}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), g AS (SELECT *, [{shape} for x in string_split(path, '/') if x <> ''] AS segments FROM h),
-- the document that a page shows: the number at the end of its path, with or without an extension
l AS (
  SELECT page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM g JOIN labels ON labels.doc_id = TRY_CAST(regexp_extract(path, '([0-9]+)([.][A-Za-z]+)?/?$', 1) AS BIGINT) GROUP BY page_id
),
p AS (
  SELECT host, segments, count(*) AS n, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad
  FROM g LEFT JOIN l ON g.page_id = l.page_id GROUP BY host, segments
), tree AS (
  SELECT host, segments, n, 0 AS i, CAST([] AS VARCHAR[]) AS parts FROM p
  UNION ALL
  SELECT host, segments, n, i + 1, list_append(parts, CASE WHEN k > {PURITY.children} AND k > {PURITY.share} * every THEN '*' ELSE x END)
  FROM (
    SELECT *, count(DISTINCT x) OVER (PARTITION BY host, parts) AS k, sum(n) OVER (PARTITION BY host, parts) AS every
    FROM (SELECT *, segments[i + 1] AS x FROM tree WHERE i < len(segments))
  )
), t AS (SELECT host, segments, parts FROM tree WHERE i = len(segments)
), a AS (
  SELECT p.host, p.segments, labelled, bad, coalesce(array_to_string(parts, '/'), '') AS template,
         coalesce(len(parts), 0) AS depth, coalesce(array_to_string(parts[1:len(parts) - 1], '/'), '') AS parent
  FROM p LEFT JOIN t ON p.host = t.host AND p.segments = t.segments
), b AS (SELECT host, depth, parent, template, sum(labelled) AS labelled, sum(bad) AS bad FROM a GROUP BY ALL),
m AS (
  SELECT *, sum(labelled) OVER w AS all_labelled, sum(bad) OVER w AS all_bad FROM b WINDOW w AS (PARTITION BY host, depth, parent)
), alike AS (
  SELECT *, CASE WHEN labelled > 0 AND all_labelled > 0 THEN NOT abs(bad / labelled - all_bad / all_labelled)
    > {PURITY.z} * sqrt(all_bad / all_labelled * (1 - all_bad / all_labelled) / labelled) ELSE true END AS alike FROM m
), j AS (
  SELECT *, sum(labelled) OVER w AS g_labelled, sum(bad) OVER w AS g_bad FROM alike
  WINDOW w AS (PARTITION BY host, depth, parent, CASE WHEN alike THEN NULL ELSE template END)
), prior AS (SELECT CASE WHEN sum(labelled) > 0 THEN sum(bad) / sum(labelled) ELSE 0 END AS r FROM a),
x AS (
  SELECT host, template, (g_bad + {PURITY.weight} * r) / (g_labelled + {PURITY.weight}) >= {PURITY.bad} AS rejected FROM j, prior
)
SELECT page_id, g.host, path, {chosen([r for _, r in rules])} AS rule,
       coalesce({chosen([v for v, _ in rules])}, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict, a.template
FROM (SELECT page_id, host, path, segments FROM g) g
JOIN a ON g.host = a.host AND g.segments = a.segments JOIN x ON a.host = x.host AND a.template = x.template
"""


def divergence() -> str:
    bins = 1 + max(map(len, COMMON.values()))
    classes = ", ".join(f"len(regexp_extract_all(t, {_quoted(c)}))" for c in CLASSES)
    common = "CASE lang " + " ".join(f"WHEN '{k}' THEN {list(ws)}" for k, ws in COMMON.items()) + " END"
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{i}])" for i in range(1, n + 1)) + "]"
    chars = len(CLASSES) + 3

    def distance(own: str, all_: str, n: int) -> str:
        def part(x: str, m: str) -> str:
            return f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ({m})) ELSE 0 END"

        terms = []
        for i in range(1, n + 1):
            p, q = f"({own}[{i}] / nullif(list_sum({own}), 0))", f"({all_}[{i}] / nullif(list_sum({all_}), 0))"
            m = f"({p} + {q}) / 2"
            terms.append(f"(({part(p, m)}) + ({part(q, m)})) / 2")
        return f"sqrt(greatest(0, {' + '.join(terms)}))"

    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)
), rep AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), cov AS (SELECT doc_id, sum(least(8, coalesce(after - i, 8))) AS n FROM rep GROUP BY doc_id),
f AS (
  SELECT d.doc_id, lang, t, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         [{classes}] AS c, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines,
         [translate(lower(w), {_quoted(PUNCTUATION)}, '') for w in ws if length(w) <= {AT_MOST}] AS ps,
         coalesce([len([w for w in ps if w = x]) for x in {common}], [{", ".join(["0"] * (bins - 1))}]) AS hits,
         coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id
), h AS (
  SELECT *, list_concat(c, [length(t) - word_chars, strlen(t) - length(t),
                            length(t) - (length(t) - word_chars) - list_sum(c)]) AS chars,
         list_concat([n_words - list_sum(hits)], hits) AS words FROM f
), r AS (SELECT lang, {sums("chars", chars)} AS all_chars, {sums("words", bins)} AS all_words FROM h GROUP BY lang),
j AS (
  SELECT h.*, {distance("chars", "all_chars", chars)} AS dc, {distance("words", "all_words", bins)} AS dw,
         {distance(str([1] + [0] * (bins - 1)), "all_words", bins)} AS alone,
         n_words < {LIMITS.words} OR 100 * n_repeat_words > {LIMITS.repeat_percent} * n_words AS base_failed
  FROM h JOIN r ON h.lang IS NOT DISTINCT FROM r.lang
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(c[4] AS BIGINT) AS n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       base_failed,
       NOT (base_failed OR coalesce(length(t) >= {LIMITS.chars_least} AND dc > {LIMITS.char_divergence}, false)
            OR coalesce(n_words >= {LIMITS.words_least} AND dw > {LIMITS.word_share} * alone, false)) AS kept
FROM j
"""
