"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from daybook.llm import decontaminate, divergence, lm_scoring, mixing, suffix_dedup, url_rules

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LENGTH = suffix_dedup.LENGTH

REPEATS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(doc_id, 9223372036854775807) AS rank,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents),
places AS (
  SELECT n, rank, s, substr(h, 2 * s - 1, 2 * {_LENGTH}) AS run
  FROM (SELECT n, rank, h, unnest(range(1, len(h) // 2 - {_LENGTH} + 2)) AS s FROM docs)),
least AS (SELECT run, min(rank) AS first FROM places GROUP BY run HAVING min(rank) < max(rank)),
hit AS (SELECT n, s FROM places JOIN least USING (run) WHERE first < rank),
opened AS (
  SELECT n, s, s > coalesce(lag(s) OVER (PARTITION BY n ORDER BY s) + {_LENGTH}, 0) AS opens FROM hit),
numbered AS (SELECT n, s, sum(opens::INTEGER) OVER (PARTITION BY n ORDER BY s) AS span FROM opened),
spans AS (
  SELECT n, span, min(s) AS a, max(s) + {_LENGTH} - 1 AS b FROM numbered GROUP BY n, span),
between_spans AS (
  SELECT n, h, a, b, coalesce(lag(b) OVER (PARTITION BY n ORDER BY a), 0) AS done
  FROM spans JOIN docs USING (n)),
cut AS (
  SELECT n, count(*) AS n_spans, sum(b - a + 1)::BIGINT AS n_removed,
         string_agg(substr(h, 2 * done + 1, 2 * (a - 1 - done)), '' ORDER BY a)
           || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM between_spans GROUP BY n)
SELECT doc_id, len(h)::BIGINT // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs LEFT JOIN cut USING (n)
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES)

URL_FILTERS = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
urls AS (
  SELECT row_number() OVER () AS n, page_id,
         {LOWER.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")} AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
fits AS (
  SELECT n, max(struct_pack(l := length(rule_host || rule_path), r := rule_host || rule_path,
                            v := rule_verdict)) AS top
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                      AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, top.r AS rule, coalesce(top.v, '{url_rules.DEFAULT}') AS verdict
FROM urls LEFT JOIN fits USING (n)
"""

_WEIGHT = f"list_value({', '.join(map(str, mixing.WEIGHTS))})[((position - 1) % {len(mixing.WEIGHTS)} + 1)::BIGINT]"
_COIN_KEY = f"concat_ws(':', '{mixing.SEED}', coalesce(doc_id::VARCHAR, '-'), text)"
_DIGITS = mixing.COIN_DIGITS

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5({_COIN_KEY}), 1, {_DIGITS}))::BIGINT / {float(16 ** _DIGITS)!r}::DOUBLE AS coin
  FROM documents),
numbered AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS position
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, {mixing.MOST_TIMES} * source_size AS most, {_WEIGHT} AS weight FROM numbered),
filling AS (
  SELECT *, sum(most) OVER o AS filled, sum(weight) OVER o AS weighed,
         sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM weighed WINDOW o AS (ORDER BY most::DOUBLE / weight, position)),
capped AS (
  SELECT *, (all_size - filled + most) * weight > most * (all_weight - weighed + weight) AS is_full
  FROM filling),
level AS (
  SELECT (any_value(all_size) - coalesce(sum(most) FILTER (is_full), 0))::DOUBLE
       / greatest(any_value(all_weight) - coalesce(sum(weight) FILTER (is_full), 0), 1)::DOUBLE AS level
  FROM capped),
rates AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN most::DOUBLE ELSE (SELECT level FROM level) * weight END AS target
  FROM capped)
SELECT doc_id, size, rates.source_size, target,
       size * (CASE WHEN rates.source_size = 0 THEN 0 ELSE floor(target / rates.source_size)
         + (coin < target / rates.source_size - floor(target / rates.source_size))::BIGINT END)::BIGINT AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""

DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, list_filter(regexp_split_to_array(
           {LOWER.format("coalesce(text, '')")}, '{decontaminate.SEPARATORS}'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           {LOWER.format("coalesce(text, '')")}, '{decontaminate.SEPARATORS}'), lambda w: w <> '') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[s : s + size - 1], ' ') AS run
  FROM (SELECT item_id, words, least(len(words), {decontaminate.WINDOW}) AS size,
               unnest(range(1, len(words) - least(len(words), {decontaminate.WINDOW}) + 2)) AS s
        FROM items WHERE len(words) > 0)),
places AS (
  SELECT n, s, size, array_to_string(words[s : s + size - 1], ' ') AS run
  FROM (SELECT n, words, size, unnest(range(1, len(words) - size + 2)) AS s
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
found AS (SELECT n, s, size, item_id FROM places JOIN windows USING (size, run)),
hit AS (
  SELECT n, count(DISTINCT place) AS n_hit FROM (SELECT n, unnest(range(s, s + size)) AS place FROM found) GROUP BY n),
which AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT n, item_id::VARCHAR AS item FROM found) GROUP BY n)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (n) LEFT JOIN which USING (n)
"""

_UNIT, _BACKOFF = lm_scoring.UNIT, lm_scoring.BACKOFF

LM_SCORING = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words
  FROM documents),
places AS (
  SELECT n, s, words[s] AS word, CASE WHEN s > 1 THEN words[s - 1] END AS before
  FROM (SELECT n, words, unnest(range(1, len(words) + 1)) AS s FROM docs)),
single AS (SELECT word, count(*) AS times FROM places GROUP BY word),
pairs AS (SELECT before, word, count(*) AS times FROM places WHERE before IS NOT NULL GROUP BY before, word),
looked AS (
  SELECT n, single.times AS alone, first.times AS had, pairs.times AS run,
         pairs.times >= {lm_scoring.LEAST_COUNT} AS seen
  FROM places JOIN single USING (word)
  LEFT JOIN single AS first ON first.word = places.before
  LEFT JOIN pairs ON pairs.before = places.before AND pairs.word = places.word),
scored AS (
  SELECT n, count(*) FILTER (had IS NOT NULL AND NOT seen) AS n_unseen,
         sum(CASE WHEN seen THEN round(ln(run / had) * {_UNIT})
                  ELSE round(ln(alone) * {_UNIT}) - round(ln((SELECT count(*) FROM places)) * {_UNIT})
                     + CASE WHEN had IS NULL THEN 0 ELSE round(ln({_BACKOFF}::DOUBLE) * {_UNIT}) END
             END)::BIGINT AS score_units
  FROM looked GROUP BY n)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_unseen, 0) AS n_unseen,
       coalesce(score_units, 0)::BIGINT AS score_units,
       CASE WHEN len(words) = 0 THEN 0 ELSE score_units / len(words) / {float(_UNIT)!r}::DOUBLE END AS score
FROM docs LEFT JOIN scored USING (n)
"""

LM_SCORING_TRIGRAMS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words
  FROM documents),
places AS (
  SELECT n, s, words[s] AS word, CASE WHEN s > 1 THEN words[s - 1] END AS before,
         CASE WHEN s > 2 THEN words[s - 2] END AS earlier
  FROM (SELECT n, words, unnest(range(1, len(words) + 1)) AS s FROM docs)),
single AS (SELECT word, count(*) AS times FROM places GROUP BY word),
pairs AS (SELECT before, word, count(*) AS times FROM places WHERE before IS NOT NULL GROUP BY before, word),
triples AS (
  SELECT earlier, before, word, count(*) AS times FROM places WHERE earlier IS NOT NULL
  GROUP BY earlier, before, word),
looked AS (
  SELECT n, single.times AS alone, first.times AS had, pairs.times AS run, led.times AS had_pair,
         triples.times AS run_triple, places.earlier IS NOT NULL AS third,
         coalesce(pairs.times >= {lm_scoring.LEAST_COUNT}, false) AS seen,
         coalesce(triples.times >= {lm_scoring.LEAST_COUNT}, false) AS seen_triple
  FROM places JOIN single USING (word)
  LEFT JOIN single AS first ON first.word = places.before
  LEFT JOIN pairs ON pairs.before = places.before AND pairs.word = places.word
  LEFT JOIN pairs AS led ON led.before = places.earlier AND led.word = places.before
  LEFT JOIN triples ON triples.earlier = places.earlier AND triples.before = places.before
                   AND triples.word = places.word),
scored AS (
  SELECT n, count(*) FILTER (had IS NOT NULL AND NOT seen AND NOT seen_triple) AS n_unseen,
         sum(CASE WHEN seen_triple THEN round(ln(run_triple / had_pair) * {_UNIT})
                  ELSE CASE WHEN third THEN round(ln({_BACKOFF}::DOUBLE) * {_UNIT}) ELSE 0 END
                     + CASE WHEN seen THEN round(ln(run / had) * {_UNIT})
                            ELSE round(ln(alone) * {_UNIT}) - round(ln((SELECT count(*) FROM places)) * {_UNIT})
                               + CASE WHEN had IS NULL THEN 0 ELSE round(ln({_BACKOFF}::DOUBLE) * {_UNIT}) END
                       END
             END)::BIGINT AS score_units
  FROM looked GROUP BY n)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_unseen, 0) AS n_unseen,
       coalesce(score_units, 0)::BIGINT AS score_units,
       CASE WHEN len(words) = 0 THEN 0 ELSE score_units / len(words) / {float(_UNIT)!r}::DOUBLE END AS score
FROM docs LEFT JOIN scored USING (n)
"""

def _share(times: str, total: str) -> str:
    return f"({divergence.SCALE}::HUGEINT * ({times} + {divergence.ADDED}) // ({total} + {divergence.ADDED} * n_terms) + 1)"


_PRICE = "((p - q) * (p - q) // (p + q))"

DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         {LOWER.format("coalesce(text, '')")} AS text
  FROM documents),
found AS (
  SELECT n, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS times FROM found GROUP BY lang, term
  HAVING count(DISTINCT n) >= {divergence.LEAST_DOCS}),
langs AS (
  SELECT lang, count(term) AS n_terms, coalesce(sum(times), 0) AS total
  FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS times FROM found SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
groups AS (
  SELECT lang, source, coalesce(sum(times), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, term, coalesce(c.times, 0) AS times,
         {_share("coalesce(c.times, 0)", "g.total")} AS p, {_share("kept.times", "langs.total")} AS of_lang
  FROM groups g JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT lang, source, item, sum({_PRICE}) AS value
  FROM (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source)
  GROUP BY lang, source, item),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, {_PRICE}::BIGINT
  FROM (SELECT *, of_lang AS q FROM shares) WHERE times > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.BEST}
"""

ORACLES = {
    "op1_suffix_array_dedup": REPEATS,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op5_url_filters": URL_FILTERS,
    "op6_lm_scoring": LM_SCORING,
    "op6_lm_scoring_trigrams": LM_SCORING_TRIGRAMS,
    "op9_mixing": MIXING,
    "op12_source_divergence": DIVERGENCE,
}
