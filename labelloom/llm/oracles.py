"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from labelloom.llm import host_quality, license_scan

SPACE = r"[\x20\x09-\x0D]"
WORDS = r"[^\x20\x09-\x0D]+"


def _host_quality() -> str:
    rules = list(host_quality.SOFT_RULES)
    broken = ", ".join(f"({rule_sql}) AS {rule}" for rule, rule_sql in host_quality.SOFT_RULES.items())
    sums = ", ".join(f"sum({rule}::bigint) AS {rule}" for rule in rules)
    moments = ", ".join(
        f"sum({rule}) / sum(n_host) AS {rule}_mean, sum({rule}::double * {rule} / n_host) AS {rule}_squares, sum({rule}) AS {rule}_sum" for rule in rules
    )
    chance = {rule: f"{rule}_mean * (1 - {rule}_mean)" for rule in rules}
    extra = {rule: f"({rule}_squares - {rule}_mean * {rule}_sum - {chance[rule]} * hosts)" for rule in rules}
    strength = {
        rule: f"least(greatest(CASE WHEN {extra[rule]} > 0 THEN {chance[rule]} * (documents - hosts) / {extra[rule]} - 1 "
        f"ELSE {host_quality.MAX_STRENGTH} END, 1), {host_quality.MAX_STRENGTH})"
        for rule in rules
    }
    strengths = ", ".join(f"{rule}_mean, {sql} AS {rule}_strength" for rule, sql in strength.items())
    verdicts = ", ".join(
        f"(h.{rule} + {rule}_mean * {rule}_strength) / (n_host + {rule}_strength) > {host_quality.MAX_HOST_RATE} AS {rule}_host" for rule in rules
    )
    against = " OR ".join(f"(m.{rule} AND {rule}_host)" for rule in rules)
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS ls
  FROM documents),
tokens AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM texts),
windows AS (
  SELECT doc_id, p, w || ' ' || lead(w) OVER d || ' ' || lead(w, 2) OVER d AS g FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows WHERE g IS NOT NULL) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
measured AS (
  SELECT doc_id, host, len(ws)::bigint AS n_words,
         length(regexp_replace(t, '{SPACE}+', '', 'g'))::bigint AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols,
         len(ls)::bigint AS n_lines, (len(ls) - len(list_distinct(ls)))::bigint AS n_dup_lines, coalesce(n, 0)::bigint AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id)),
marked AS (SELECT *, {broken} FROM measured),
hosts AS (SELECT host, count(*) AS n_host, {sums} FROM marked GROUP BY host),
moments AS (SELECT count(*) AS hosts, sum(n_host) AS documents, {moments} FROM hosts),
priors AS (SELECT {strengths} FROM moments),
verdicts AS (SELECT host, {verdicts} FROM hosts h, priors),
judged AS (
  SELECT m.*, n_words < {host_quality.MIN_WORDS} OR 100 * n_repeat_words > {host_quality.MAX_REPEAT_PERCENT} * n_words AS base_failed, {against} AS against
  FROM marked m JOIN verdicts USING (host))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT against AS kept FROM judged"""


EXACT_DEDUP = rf"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)"""

WARC = """
WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads),
kinds AS (SELECT *, payload_bytes >= 100 AND page_id <> first AS again FROM firsts)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM kinds"""


def _license_scan() -> str:
    rows = [
        f"('{name}', {number}, '{word}', {tf})"
        for (name, number), words in license_scan.template_words(license_scan.TEMPLATES).items()
        for word, tf in words.items()
    ]
    word = license_scan.WORD
    return rf"""
WITH templates(license, template, word, tf) AS (VALUES {", ".join(rows)}),
files AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || doc_id || '.txt' AS path,
         coalesce(source, 'none') || '/' || coalesce(lang, 'none') AS dir, coalesce(text, '') AS t,
         regexp_extract_all(lower(coalesce(text, '')), '{word}') AS ws
  FROM documents),
size AS (SELECT count(*) AS n FROM files),
having_word AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(ws) AS word FROM files) GROUP BY word),
idf AS (
  SELECT word, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT word FROM templates) LEFT JOIN having_word USING (word), size),
shares AS (
  SELECT license, template, word, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY license, template)) AS share
  FROM templates JOIN idf USING (word)),
statements AS (
  SELECT doc_id, unnest(list_distinct(list_concat(string_split(t, chr(10)), regexp_split_to_array(t, '\n[\x20\x09\r]*\n')))) AS s FROM files),
tokens AS (SELECT doc_id, s, word, count(*) AS tf FROM (SELECT doc_id, s, unnest(regexp_extract_all(lower(s), '{word}')) AS word FROM statements) GROUP BY ALL),
weights AS (SELECT doc_id, s, word, tf * coalesce(idf, ln(n + 1) + 1) AS weight FROM tokens LEFT JOIN idf USING (word), size),
lengths AS (SELECT doc_id, s, sqrt(sum(weight * weight)) AS length FROM weights GROUP BY ALL),
dots AS (SELECT doc_id, s, license, template, sum(weight * share) AS dot FROM weights JOIN shares USING (word) GROUP BY ALL),
found AS (
  SELECT doc_id, s, license, round(dot / length, 6) AS cosine FROM dots JOIN lengths USING (doc_id, s)
  WHERE round(dot / length, 6) >= {license_scan.THRESHOLD}),
own AS (
  SELECT doc_id, license, cosine FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) = 1),
whole AS (
  SELECT doc_id, bool_or(10 * len(regexp_extract_all(lower(s), '{word}')) >= 9 * len(ws)) AS is_license_file
  FROM found JOIN files USING (doc_id) GROUP BY doc_id),
licensed AS (
  SELECT dir, license FROM files JOIN own USING (doc_id) JOIN whole USING (doc_id) WHERE is_license_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, path, license) = 1)
SELECT doc_id, path, coalesce(o.license, l.license) AS license, cosine,
       CASE WHEN o.license IS NOT NULL THEN 'own' WHEN l.license IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN o.license IS NULL AND l.license IS NOT NULL THEN l.dir END AS license_dir
FROM files LEFT JOIN own o USING (doc_id) LEFT JOIN licensed l USING (dir)"""


#: Words by brute counting with the digest worked out byte by byte; near words by the words that one deletion leaves.
SPELLING = r"""WITH RECURSIVE steps AS (
  SELECT list(list_reduce(list_prepend(i::UBIGINT, [0::UBIGINT for x in range(8)]),
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS of
  FROM range(256) t(i)),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
raw AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits FROM runs),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      [('0x' || substr(digits, i + 1, 2))::UBIGINT for i in range(0, length(digits), 2)]),
      lambda c, b: xor(c >> 8, of[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT) AS h
  FROM raw, steps),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times
  FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
shorter AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
best AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM pairs GROUP BY word, n),
forms AS (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
chain AS (
  SELECT word, form AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root),
roots AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT words.word, forms.form, coalesce(roots.root, words.word) AS root, words.n, coalesce(best.n_near, 0)::BIGINT AS n_near, forms.form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)"""

#: Every pair of usable vectors, and what links reach.
VECTORS = """WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
  SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN counted ON counted.a = vec_id"""


def all_sql() -> dict[str, str]:
    return {
        "op2_host_quality": _host_quality(),
        "op4_exact_dedup": EXACT_DEDUP,
        "op6_warc": WARC,
        "op7_license_scan": _license_scan(),
        "op11_spelling": SPELLING,
        "op12_vector_graph": VECTORS,
    }
