"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

from . import license_scan, lm_score, quality_rules, resampling, url_filter

#: Words of a text as DuckDB writes them: runs of characters other than U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _count(column: str, letters: str) -> str:
    """How many characters of `column` are among letters."""
    return f"(length({column}) - length(translate({column}, {_quoted(letters)}, '')))"


def quality_rules_sql() -> str:
    q = quality_rules
    white = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    phrases = " + ".join(f"CASE WHEN regexp_matches(lower(line), {_quoted(rf'\b{p}\b')}) THEN {q.word_chars(p)} ELSE 0 END" for p in q.BOILERPLATE)
    some = " OR ".join(f"contains(lower(line), {_quoted(p)})" for p in q.BOILERPLATE)
    marks = " OR ".join(f"contains(line, {_quoted(m)})" for m in q.SENTENCE_MARKS)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
    length(text) - length(text) + length(translate(text, {white}, '')) AS word_chars, {_count("text", q.SYMBOLS)} AS n_symbols,
    CASE WHEN text = '' THEN 0 ELSE length(text) - length(translate(text, chr(10), '')) + 1 END AS n_lines FROM docs),
places AS (SELECT r, unnest(generate_series(1, len(words) - 2)) AS i, words FROM base WHERE len(words) >= 4),
windows AS (SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM places),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT r, i FROM again UNION SELECT r, i + 1 FROM again UNION SELECT r, i + 2 FROM again) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM base WHERE text <> ''),
filled AS (
  SELECT r, line, length(translate(line, {white}, '')) AS chars, len(regexp_extract_all(line, '{WORD}')) AS words,
    {_count("line", q.NAVIGATION_MARKS)} AS bars, {_count("line", q.SYMBOLS)} AS symbols FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
judged AS (
  SELECT r, line, chars, CASE WHEN bars >= 2 AND bars * {q.NAVIGATION_WORDS} >= words THEN 'n'
    WHEN symbols > 0 AND 100 * symbols > {q.MAX_SYMBOL_PERCENT} * chars THEN 'b'
    WHEN ({some}) AND ({phrases}) > 0 AND 100 * ({phrases}) >= {q.MIN_PHRASE_PERCENT} * chars THEN 'b' WHEN {marks} THEN '' ELSE 'p' END AS verdict FROM filled),
per_doc AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup, count(*) FILTER (verdict = 'p') AS p, count(*) FILTER (verdict = 'n') AS n,
    count(*) FILTER (verdict = 'b') AS b, coalesce(sum(chars) FILTER (verdict <> ''), 0) AS lost FROM judged GROUP BY r),
whole AS (
  SELECT doc_id, len(words) AS n_words, word_chars, n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    n_lines, coalesce(p, 0) AS p, coalesce(per_doc.n, 0) AS n, coalesce(b, 0) AS b, coalesce(lost, 0) AS lost
  FROM base LEFT JOIN covered USING (r) LEFT JOIN per_doc USING (r)),
failed AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM whole)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(n_lines AS BIGINT) AS n_lines,
  CAST(p AS BIGINT) AS n_punctuation_lines, CAST(n AS BIGINT) AS n_navigation_lines, CAST(b AS BIGINT) AS n_boilerplate_lines,
  CAST(lost AS BIGINT) AS lost_chars, NOT base_failed AND 100 * lost <= {q.MAX_LOST_PERCENT} * word_chars AS kept
FROM failed"""


def url_filter_sql() -> str:
    u = url_filter
    rules = sorted(u.RULES, key=lambda r: (-len(r.name), -len(r.host)))

    def fit(r) -> str:
        return f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"

    rule = "CASE " + " ".join(f"WHEN {fit(r)} THEN '{r.name}'" for r in rules) + " END"
    ruled = "CASE " + " ".join(f"WHEN {fit(r)} THEN '{r.verdict}'" for r in rules) + " END"

    suffixes = ", ".join(map(_quoted, u.SUFFIXES))

    def strength(table: str) -> str:
        return f"""(SELECT greatest({u.WEAKEST}, least({u.STRONGEST}, coalesce(CASE WHEN between_ > 0 THEN (within_ - between_) / between_ ELSE {u.STRONGEST} END, {u.STRONGEST}))) FROM (
    SELECT within_, (spread - (g - 1) * within_) / nullif(n - squares / nullif(n, 0), 0) AS between_ FROM (
      SELECT sum(n) AS n, count(*) AS g, sum(n * n) AS squares, sum(bad) / nullif(sum(n), 0) * (1 - sum(bad) / nullif(sum(n), 0)) AS within_,
        sum(bad * bad / n) - sum(bad) * sum(bad) / nullif(sum(n), 0) AS spread FROM {table} WHERE n > 0)))"""

    return f"""
WITH read AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
outcomes AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(1 - quality) AS DOUBLE) AS bad FROM read JOIN labels ON doc_id = page_id WHERE quality IN (0, 1) GROUP BY 1),
names AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM (SELECT DISTINCT host FROM read)),
labelled AS (
  SELECT host, name, string_split(name, '.') AS labels, array_to_string(string_split(name, '.')[-2:], '.') AS two,
    starts_with(name, '[') OR regexp_full_match(name, '([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}') AS address FROM names),
hosts AS (
  SELECT host, CASE WHEN address THEN name WHEN two IN ({suffixes}) THEN array_to_string(labels[-3:], '.') ELSE two END AS domain,
    CASE WHEN address THEN '{u.ADDRESS}' WHEN two IN ({suffixes}) THEN two ELSE labels[-1] END AS suffix, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad
  FROM labelled LEFT JOIN outcomes USING (host)),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
k AS (SELECT {strength("suffixes")} AS ks, {strength("domains")} AS kd, {strength("hosts")} AS kh, coalesce((SELECT sum(bad) / sum(n) FROM suffixes), 0.0) AS m),
s AS (SELECT suffix, (bad + ks * m) / (n + ks) AS suffix_mean FROM suffixes, k),
d AS (SELECT domain, (bad + kd * suffix_mean) / (n + kd) AS domain_mean FROM domains JOIN s USING (suffix), k),
h AS (SELECT host, (bad + kh * domain_mean) / (n + kh) AS mean, n + kh + 1 AS size FROM hosts JOIN d USING (domain), k),
bounds AS (SELECT host, mean - {u.BOUND} * sqrt(mean * (1 - mean) / size) AS bound FROM h)
SELECT page_id, host, path, {rule} AS rule, coalesce({ruled}, CASE WHEN bound > {u.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, round(bound, 6) AS bound
FROM read LEFT JOIN bounds USING (host)"""


def lm_score_sql() -> str:
    """Order 3: c1, c2, c3 are the counts of a word, of the pair and of the triple that end with it, p1 and p2 those of the last two without it."""
    a = lm_score.ALPHA

    def others(n: int, words: str) -> str:
        cut = f"i >= {n}"
        return f"""own{n} AS (SELECT r, {words}, count(*) AS c FROM tokens WHERE {cut} GROUP BY ALL),
all{n} AS (SELECT {words}, sum(c) AS c FROM own{n} GROUP BY ALL),
rest{n} AS (SELECT own{n}.*, all{n}.c - own{n}.c AS o FROM own{n} JOIN all{n} USING ({words}))"""

    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
places AS (SELECT r, words, unnest(generate_series(1, len(words))) AS i FROM docs WHERE len(words) > 0),
tokens AS (SELECT r, i, words[i] AS w, CASE WHEN i > 1 THEN words[i - 1] END AS v, CASE WHEN i > 2 THEN words[i - 2] END AS u, len(words) AS n FROM places),
{others(1, "w")},
{others(2, "v, w")},
{others(3, "u, v, w")},
total AS (SELECT count(*) AS t FROM tokens),
counted AS (
  SELECT x.r, x.i, t - x.n AS rest, r1.o AS c1, r2.o AS c2, r3.o AS c3, q1.o AS p1, q2.o AS p2
  FROM tokens x CROSS JOIN total JOIN rest1 r1 ON r1.r = x.r AND r1.w = x.w
  LEFT JOIN rest2 r2 ON r2.r = x.r AND r2.v = x.v AND r2.w = x.w LEFT JOIN rest3 r3 ON r3.r = x.r AND r3.u = x.u AND r3.v = x.v AND r3.w = x.w
  LEFT JOIN rest1 q1 ON q1.r = x.r AND q1.w = x.v LEFT JOIN rest2 q2 ON q2.r = x.r AND q2.v = x.u AND q2.w = x.v),
one AS (SELECT *, CASE WHEN c1 > 0 THEN ln(c1 / greatest(rest, 1)) ELSE ln({a}::DOUBLE / (rest + 1)) END AS s1 FROM counted),
two AS (SELECT *, CASE WHEN i = 1 THEN s1 WHEN c2 > 0 THEN ln(c2 / p1) ELSE ln({a}::DOUBLE) + s1 END AS s2 FROM one),
summed AS (
  SELECT r, count(*) AS n, sum(CASE WHEN i < 3 THEN s2 WHEN c3 > 0 THEN ln(c3 / p2) ELSE ln({a}::DOUBLE) + s2 END) AS s,
    count(*) FILTER (CASE WHEN i = 2 THEN c2 <= 0 WHEN i > 2 THEN c3 <= 0 END) AS backed, count(*) FILTER (c1 <= 0) AS unseen FROM two GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(backed, 0) AS BIGINT) AS n_backed_off, CAST(coalesce(unseen, 0) AS BIGINT) AS n_unseen, round(s / n, 6) AS mean_log_score
FROM docs LEFT JOIN summed USING (r)"""


#: Words of op11 and op12, of a text in which A-Z are lower-cased.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{PLAIN_WORD}')"


def license_scan_sql() -> str:
    templates = [*license_scan.BASE, *license_scan.NOTICES]
    names = ", ".join(f"({t}, {_quoted(x.label)}, {x.slack}, {len(x.text.split())}, {t < len(license_scan.BASE)})" for t, x in enumerate(templates))
    words = ", ".join(f"({t}, {p}, {_quoted(w)})" for t, x in enumerate(templates) for p, w in enumerate(x.text.split()))
    keys = ", ".join(f"({t}, {k}, {p}, {_quoted(w)}, {len(key.split())}, {len(x.keys)})" for t, x in enumerate(templates) for k, key in enumerate(x.keys) for p, w in enumerate(key.split()))
    return f"""
WITH template(t, label, slack, size, base) AS (VALUES {names}), posting(t, p, w) AS (VALUES {words}), keyed(t, k, p, w, size, n_keys) AS (VALUES {keys}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS words FROM documents),
places AS (SELECT r, words, unnest(generate_series(1, len(words))) AS i FROM docs WHERE len(words) > 0),
hits AS (SELECT r, i - 1 AS i, words[i] AS w FROM places WHERE words[i] IN (SELECT w FROM posting)),
present AS (SELECT DISTINCT r, w FROM hits),
idf AS (SELECT w, ln(((SELECT count(*) FROM docs) + 1) / (count(r) + 1)::DOUBLE) AS idf FROM (SELECT DISTINCT w FROM posting) LEFT JOIN present USING (w) GROUP BY w),
needed AS (SELECT t, count(DISTINCT w) AS n FROM keyed GROUP BY t),
able AS (SELECT r, t FROM (SELECT r, t, count(*) AS n FROM present JOIN (SELECT DISTINCT t, w FROM keyed) USING (w) GROUP BY r, t) JOIN needed USING (t, n)),
looked AS (SELECT r, t, w FROM able JOIN (SELECT DISTINCT t, w FROM posting) USING (t) JOIN present USING (r, w) JOIN idf USING (w)
  QUALIFY row_number() OVER (PARTITION BY r, t ORDER BY idf DESC, w) <= {license_scan.LOOKED_UP}),
begins AS (SELECT DISTINCT r, t, w, i - p AS s FROM looked JOIN posting USING (t, w) JOIN hits USING (r, w)),
voted AS (SELECT a.r, a.t, a.s, count(DISTINCT b.w) AS votes FROM (SELECT DISTINCT r, t, s FROM begins) a JOIN template USING (t)
  JOIN begins b ON b.r = a.r AND b.t = a.t AND b.s BETWEEN a.s - slack AND a.s + slack GROUP BY ALL),
aligned AS (SELECT r, t, s FROM voted JOIN (SELECT r, t, count(*) AS n FROM looked GROUP BY r, t) USING (r, t) JOIN template USING (t) WHERE CASE WHEN slack = 0 THEN votes = n ELSE 2 * votes > n END),
keyplaces AS (SELECT r, t, k, i - p AS s FROM able JOIN keyed USING (t) JOIN hits USING (r, w) GROUP BY ALL HAVING count(*) = any_value(size)),
verified AS (SELECT a.r, a.t, a.s FROM aligned a JOIN template USING (t) JOIN keyed ON keyed.t = a.t AND keyed.p = 0
  JOIN keyplaces b ON b.r = a.r AND b.t = a.t AND b.k = keyed.k AND b.s BETWEEN a.s - slack AND a.s + template.size - keyed.size + slack
  GROUP BY a.r, a.t, a.s HAVING count(DISTINCT keyed.k) = any_value(keyed.n_keys)),
held AS (SELECT DISTINCT v.r, v.t, v.s, p, posting.w FROM verified v JOIN template USING (t) JOIN posting USING (t) JOIN hits h ON h.r = v.r AND h.w = posting.w AND h.i BETWEEN v.s + p - slack AND v.s + p + slack),
weight AS (SELECT t, sum(idf) AS whole FROM posting JOIN idf USING (w) GROUP BY t),
share AS (SELECT r, t, s, sum(idf) / any_value(whole) AS share FROM held JOIN idf USING (w) JOIN weight USING (t) GROUP BY r, t, s),
matched AS (SELECT r, t, s, label, base, CASE WHEN base THEN 1.0 ELSE share END AS share FROM share JOIN template USING (t)),
found AS (SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
  list_sort(list(DISTINCT label) FILTER (base)) AS bases, list_sort(list(DISTINCT label)) AS every, max(share) AS score FROM matched GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(bases, ','), '') AS base_labels, coalesce(array_to_string(every, ','), '') AS labels, coalesce(round(score, 6), 0.0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (r)"""


def resampling_sql(percent: int = 10, least_words: int = 20, seed: int = 2024) -> str:
    k = resampling.BUCKETS
    crc = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda x: ('0x' || x)::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"
    return f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS words FROM documents),
features AS (SELECT r, unnest(words) AS w FROM docs),
wanted AS (SELECT unnest({PLAIN_WORDS}) AS w FROM benchmark),
bucket AS (SELECT w, {crc} % {k} AS b FROM (SELECT w FROM features UNION SELECT w FROM wanted), crc),
source AS (SELECT b, count(*) AS s FROM features JOIN bucket USING (w) GROUP BY b),
target AS (SELECT b, count(*) AS t FROM wanted JOIN bucket USING (w) GROUP BY b),
totals AS (SELECT (SELECT count(*) FROM features)::DOUBLE AS ss, (SELECT count(*) FROM wanted)::DOUBLE AS tt),
gain AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + {k}) / ((coalesce(s, 0) + 1)::DOUBLE * (tt + {k}))))::BIGINT AS g FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN source USING (b) LEFT JOIN target USING (b), totals),
summed AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS g FROM features JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r),
weighed AS (SELECT docs.r, doc_id, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END AS weight,
  ('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM docs LEFT JOIN summed USING (r)),
scored AS (SELECT r, doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank FROM scored WHERE n_features >= {least_words}
  QUALIFY rank <= {percent} * count(*) OVER () // 100)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CAST(rank AS BIGINT) AS rank FROM scored LEFT JOIN drawn USING (r)"""


HARD_NEGATIVES = """
WITH rows_ AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM rows_ a JOIN rows_ b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5"""


ORACLES = {
    "op1_quality_rules": quality_rules_sql(),
    "op8_url_filter": url_filter_sql(),
    "op9_lm_score": lm_score_sql(),
    "op11_license_scan": license_scan_sql(),
    "op12_importance_resample": resampling_sql(),
    "op13_hard_negatives": HARD_NEGATIVES,
}
