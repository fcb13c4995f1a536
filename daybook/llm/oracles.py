"""DuckDB SQL for the queries that SQL can express."""

from daybook.llm import licenses, mixing, pivots, quality, ranked, warc

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS.format(text='t')} AS ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
runs AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS run FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouts,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echo_words
  FROM w LEFT JOIN covered c USING (r)),
b AS (
  SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)::INT + 16 * (10 * n_shouts > 3 * n_words)::INT
    + 32 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT + 64 * (100 * n_repeat_words > 15 * n_words)::INT
    + 128 * (n_symbols > n_words)::INT + 256 * (10 * n_echo_words > 3 * n_words)::INT AS bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {quality.BASE}) <> 0 AS base_failed,
  (bits & {quality.POLICIES[quality.POLICY]}) = 0 AS kept, bits::BIGINT AS bits
FROM b
"""

_ABLATED = " UNION ALL ".join(
    f"""SELECT '{name}' AS policy, '{rule.name}' AS rule, count(*) FILTER (bits & {1 << rule.bit} <> 0) AS n_failed,
  count(*) FILTER (bits & {want} = {1 << rule.bit}) AS n_only, count(*) FILTER (bits & {want} = 0) AS n_kept,
  count(*) FILTER (bits & {want & ~(1 << rule.bit)} = 0) AS n_kept_without FROM ledger"""
    for name, want in quality.POLICIES.items() for rule in quality.RULES if want >> rule.bit & 1)

QUALITY_ABLATION = f"WITH ledger AS MATERIALIZED ({QUALITY_RULES}) {_ABLATED}"

MIXED_SOURCES = f"""
WITH sizes AS (SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
rates AS (SELECT source, w / (SELECT sum(w) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS rate FROM sizes),
draws AS (SELECT source, ceil(rate / {mixing.MEAN})::BIGINT AS m, rate / ceil(rate / {mixing.MEAN}) AS mean FROM rates),
upto AS (SELECT source, k, sum(exp(-mean) * pow(mean, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k) AS p
  FROM draws, range(0, {mixing.TERMS}) t(k)),
d AS (SELECT row_number() OVER () AS r, *, '{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS key FROM documents),
u AS (SELECT r, source, ('0x' || substr(md5(key || ':' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM (SELECT r, d.source, key, unnest(range(1, m + 1)) AS j FROM d JOIN draws ON d.source IS NOT DISTINCT FROM draws.source)),
n AS (SELECT r, count(*) AS n FROM u JOIN upto ON u.source IS NOT DISTINCT FROM upto.source AND p <= u GROUP BY r)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5(key || ':order:' || copy) AS shuffle_key
FROM (SELECT d.*, unnest(range(1, n.n + 1)) AS copy FROM d JOIN n USING (r))
"""


def _values() -> str:
    rows = licenses.gram_rows(licenses.PHRASES + licenses.TEMPLATES)
    return ", ".join(f"({t}, {p}, '{a}', '{b}', {str(x).lower()}, {g}, '{label}')" for t, p, a, b, x, g, label in rows)


_LICENSE_WORDS = rf"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.GAP}'), lambda w: w <> '')"

LICENSE_SCAN = f"""
WITH grams(template, place, w1, w2, exact, grams, label) AS (VALUES {_values()}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_LICENSE_WORDS} AS ws FROM documents),
hit AS (SELECT r, template, exact, grams, label, place, p, p - place AS diagonal
  FROM (SELECT r, p, ws[p + 1] AS a, ws[p + 2] AS b FROM (SELECT r, ws, unnest(range(0, len(ws) - 1)) AS p FROM d)) JOIN grams ON a = w1 AND b = w2),
vote AS (SELECT r, template, exact, grams, label, diagonal, count(*) AS n, min(p) AS first, list(place) AS places FROM hit GROUP BY ALL),
keep AS (SELECT * FROM vote WHERE CASE WHEN exact THEN n = grams ELSE n >= {licenses.VOTES} END),
step AS (SELECT *, CASE WHEN NOT exact AND diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= {licenses.NEAR} THEN 0 ELSE 1 END AS apart FROM keep),
span AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM step),
merged AS (SELECT r, template, exact, label, span, min(first) AS first, len(list_distinct(flatten(list(places)))) / any_value(grams) AS cover
  FROM span GROUP BY r, template, exact, label, span),
docs AS (SELECT r, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
  list_sort(list_distinct(list(label) FILTER (exact))) AS base_labels, list_sort(list_distinct(list(label) FILTER (exact OR cover >= {licenses.COVER}))) AS labels, max(cover) AS score
  FROM merged GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels, coalesce(array_to_string(labels, ','), '') AS labels, least(coalesce(score, 0.0), 1.0)::DOUBLE AS score
FROM d LEFT JOIN docs USING (r)
"""

TRANSACTION_ASSEMBLY = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d),
t AS (SELECT *, payload_bytes >= {warc.LEAST} AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to, url
FROM t
"""

_ASSIGN = """
near{i} AS (SELECT x.r, x.p, c.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda k: (x.v[k] - c.v[k]) * (x.v[k] - c.v[k]))) AS d
  FROM part x JOIN book{i} c USING (p)),
code{i} AS (SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM near{i} GROUP BY r, p)"""

#: Round down: the remainder is brought to the divisor's sign first.
_ROUND = """
comp{i} AS (SELECT x.p, c.best.e AS e, k, sum(x.v[k])::BIGINT AS s, count(*) AS n
  FROM code{i} c JOIN part x USING (r, p), range(1, (SELECT max(len(v)) FROM part) + 1) t(k) GROUP BY ALL),
mean{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS v FROM comp{i} GROUP BY p, e),
book{j} AS (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m USING (p, e))"""

LAESA_CODES = f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({pivots.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT r, p, v[p * len(v) // {pivots.PARTS} + 1:(p + 1) * len(v) // {pivots.PARTS}] AS v FROM kept, range({pivots.PARTS}) t(p)),
book0 AS (SELECT p, r - 1 AS e, v FROM part WHERE r <= {pivots.ENTRIES}),
{_ASSIGN.format(i=0)},{_ROUND.format(i=0, j=1)},
{_ASSIGN.format(i=1)},{_ROUND.format(i=1, j=2)},
{_ASSIGN.format(i=2)},
row AS (SELECT r, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM code2 GROUP BY r),
sha AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN row USING (r), sha
"""

_TERMS = rf"regexp_extract_all(translate({{text}}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ranked.TERM}')"

RANKED_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(text="coalesce(text, '')")} AS ts FROM documents),
total AS (SELECT count(*) AS docs, sum(len(ts))::BIGINT AS terms FROM d WHERE len(ts) > 0),
asked AS (SELECT DISTINCT i, item_id, term FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS.format(text="coalesce(text, '')")}) AS term FROM benchmark)),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs),
impact AS (SELECT tf.r, tf.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ts) * docs) // terms))) AS x FROM tf JOIN w USING (term) JOIN d USING (r), total),
score AS (SELECT i, item_id, r, sum(x)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY ALL HAVING sum(x) > 0),
best AS (SELECT i, item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score JOIN d USING (r))
SELECT item_id, rank::INT AS rank, doc_id, score FROM best WHERE rank <= {ranked.K}
"""

ORACLES = {
    "op11_transaction_assembly": TRANSACTION_ASSEMBLY,
    "op12_laesa_codes": LAESA_CODES,
    "op13_ranked_search": RANKED_SEARCH,
    "op2_quality_rules": QUALITY_RULES,
    "quality_ablation": QUALITY_ABLATION,
    "op5_mixed_sources": MIXED_SOURCES,
    "op6_license_scan": LICENSE_SCAN,
}
