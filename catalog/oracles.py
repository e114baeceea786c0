"""DuckDB SQL for the registered queries, written straight on whole texts and rows.

Patterns and parameters are shared with the Spark side; the logic is not.
"""

from __future__ import annotations

from catalog import settings
from labelloom.functions import text as tx


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


PAIRS = (("train", "val"), ("train", "test"), ("val", "test"))



def _ranges(ranges: tuple[tuple[int, int], ...]) -> str:
    return "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges)


NOT_SPACE = f"[^{_ranges(tx.SPACE_RANGES)}]"
URL = rf"(?i)(?:https?://|www\.){NOT_SPACE}+"
EMOJI = f"[{_ranges(tx.EMOJI_RANGES)}]"
SEPARATORS = "".join("\\" + c if c in "[]\\^-&" else c for c in tx.SEQUENCE_SEPARATORS)
QUANTILES = {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
STOP = ", ".join(_q(w) for w in settings.stop_words())

DOCS = "docs AS (SELECT doc_id, text, source AS label FROM documents)"
DOCS_LANG = "docs AS (SELECT doc_id, text, lang AS label FROM documents)"
RATED = "docs AS (SELECT d.doc_id, text, quality::VARCHAR AS label FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
EVENTS = "docs AS (SELECT event_id AS doc_id, props AS text, event_type AS label FROM events)"
ORDERS = "docs AS (SELECT o_orderkey AS doc_id, o_custkey::VARCHAR AS text, o_orderstatus AS label FROM orders)"
GROUPS = """grp AS (
  SELECT text, count(DISTINCT label) AS n_labels, count(*) AS n_rows, min(doc_id) AS first_doc,
         string_agg(DISTINCT label, ' + ' ORDER BY label) AS combination
  FROM docs GROUP BY text)"""
CONFLICTS = "bad AS (SELECT text FROM docs GROUP BY text HAVING count(DISTINCT label) > 1)"
CLEAN = """docs AS (
  SELECT doc_id, text, lang AS label FROM documents
  WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text HAVING count(DISTINCT lang) = 1))"""

REPEATED = """length(array_to_string(list_transform(
    list_zip(chars, chars[2:], chars[3:]),
    lambda z: CASE WHEN z[1] = z[2] AND z[2] = z[3] AND z[1] <> chr(10) THEN 'x' ELSE '' END), '')) > 0"""


def _chars(column: str) -> str:
    return f"regexp_extract_all({column}, '(?s).')"


def _flags(source: str, text: str, keys: str) -> str:
    return f"""SELECT {keys},
  regexp_matches({text}, {_q(URL)}) AS has_urls,
  regexp_matches({text}, {_q(tx.MENTION)}) AS has_mentions,
  regexp_matches({text}, {_q(tx.HASHTAG)}) AS has_hashtags,
  regexp_matches({text}, {_q(EMOJI)}) AS has_emojis,
  {REPEATED} AS has_repeated_chars
FROM (SELECT *, {_chars(text)} AS chars FROM {source})"""


def _presence(source: str, text: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {_q(f)} AS feature, count(*) FILTER (has_{f}) AS n, "
        f"round(count(*) FILTER (has_{f})::DOUBLE / count({text}) * 100, 4) AS pct FROM f"
        for f in tx.FLAG_NAMES
    )
    return f"WITH f AS ({_flags(source, text, text)}) {parts}"


def _stats(length: str, source: str) -> str:
    quantiles = ", ".join(f"round(quantile_cont(x, {p}), 2) AS {n}" for n, p in QUANTILES.items())
    return f"""SELECT min(x)::DOUBLE AS min, max(x)::DOUBLE AS max, round(avg(x), 2) AS mean,
  round(stddev_samp(x), 2) AS std, {quantiles}
FROM (SELECT {length} AS x FROM {source})"""


def _word_count(text: str) -> str:
    return f"len(regexp_extract_all({text}, {_q(NOT_SPACE + '+')}))"


def _profile_report(docs: str, table: str, columns: dict[str, str], label: str) -> str:
    """``docs`` is a CTE named docs with doc_id, text, label; ``columns`` are those of the profiled table, by ``table``'s expressions."""
    fixed = [("shape", "n_cols", len(columns)), ("roles", "text text", 1), ("roles", f"label {label}", 1)]
    fixed += [("columns", f"{name} {kind}", place) for place, (name, kind) in enumerate(columns.items())]
    values = ", ".join(f"({_q(section)}, {_q(item)}, {value}::DOUBLE)" for section, item, value in fixed)
    missing = " UNION ALL ".join(
        f"SELECT 'missing_values', {_q(c)}, (count(*) - count({c}))::DOUBLE FROM {table} UNION ALL "
        f"SELECT 'missing_percentages', {_q(c)}, round((count(*) - count({c}))::DOUBLE / count(*) * 100, 4) FROM {table}"
        for c in columns
    )
    flags = " UNION ALL ".join(
        f"SELECT 'totals' AS section, {_q(f)} AS item, count(*) FILTER (has_{f})::DOUBLE AS value FROM f"
        for f in tx.FLAG_NAMES
    )
    stats = " UNION ALL ".join(
        f"SELECT {_q(section)}, unnest({names}), unnest({values}) FROM ({_stats(length, 'docs')})"
        for section, length in (("char_length", "length(text)"), ("word_length", _word_count("text")))
        for names in ["[" + ", ".join(_q(n) for n in ("min", "max", "mean", "std", *QUANTILES)) + "]"]
        for values in ["[" + ", ".join(("min", "max", "mean", "std", *QUANTILES)) + "]"]
    )
    return f"""WITH {docs}, {GROUPS}, f AS ({_flags("docs", "text", "text")})
{flags}
UNION ALL SELECT 'totals', 'n_rows', count(*)::DOUBLE FROM docs
UNION ALL SELECT 'totals', 'null_text_values', count(*) FILTER (text IS NULL)::DOUBLE FROM docs
UNION ALL SELECT 'totals', 'empty_whitespace_texts',
  count(*) FILTER (NOT regexp_matches(text, {_q(NOT_SPACE)}))::DOUBLE FROM docs
UNION ALL SELECT 'totals', 'exact_duplicate_rows',
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, label FROM docs)))::DOUBLE FROM docs
UNION ALL SELECT 'totals', 'duplicate_text_rows',
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM docs)))::DOUBLE FROM docs
UNION ALL SELECT 'totals', 'texts_with_conflicting_labels', count(*) FILTER (n_labels > 1)::DOUBLE FROM grp
UNION ALL SELECT 'totals', 'non_ascii_rows', count(*) FILTER (regexp_matches(text, {_q(tx.NON_ASCII)}))::DOUBLE FROM docs
UNION ALL SELECT 'class_counts', label, count(*)::DOUBLE FROM docs GROUP BY label
UNION ALL SELECT 'class_percentages', label, round(count(*)::DOUBLE / (SELECT count(*) FROM docs) * 100, 4)
  FROM docs GROUP BY label
UNION ALL SELECT 'labels', label, (row_number() OVER (ORDER BY label) - 1)::DOUBLE FROM (SELECT DISTINCT label FROM docs WHERE label IS NOT NULL)
UNION ALL {missing}
UNION ALL SELECT * FROM (VALUES {values}) AS v(section, item, value)
UNION ALL {stats}"""


def _profiling() -> dict[str, str]:
    roles = "text lang source".split()
    distinct = " UNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, {i} AS o, count(DISTINCT {c}) AS n FROM documents"
        for i, c in enumerate(roles)
    )
    columns = "doc_id text lang source n_chars".split()
    missing = " UNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c}))::DOUBLE / count(*) * 100, 4) AS missing_pct FROM documents"
        for c in columns
    )
    return {
        "profile_shape": """SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT count(*) FROM t)::INT AS n_cols,
  (row_number() OVER () - 1)::INT AS ordinal, column_name,
  CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS data_type FROM t""".replace(
            "FROM t)", "FROM (DESCRIBE documents))"
        ).replace("AS data_type FROM t", "AS data_type FROM (DESCRIBE documents)"),
        "class_distribution": """SELECT source AS label, count(*) AS n,
  round(count(*)::DOUBLE / (SELECT count(*) FROM documents) * 100, 4) AS pct FROM documents GROUP BY source""",
        "class_distribution_zero_filled": f"""WITH {DOCS}, kept AS (
  SELECT label FROM docs WHERE doc_id IN (SELECT min(doc_id) FROM docs GROUP BY text HAVING count(DISTINCT label) = 1))
SELECT l.label, count(k.label) AS n, round(count(k.label)::DOUBLE / (SELECT count(*) FROM kept) * 100, 4) AS pct
FROM (SELECT DISTINCT label FROM docs) l LEFT JOIN kept k ON l.label = k.label GROUP BY l.label""",
        "missing_values": missing,
        "duplicate_rows": """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents))
  AS duplicate_rows FROM documents""",
        "duplicate_counts": f"""WITH {DOCS}, {CONFLICTS} SELECT
  (SELECT count(*) FROM docs) - (SELECT count(*) FROM (SELECT DISTINCT text, label FROM docs)) AS exact_duplicate_rows,
  (SELECT count(*) FROM docs) - (SELECT count(*) FROM (SELECT DISTINCT text FROM docs)) AS duplicate_text_rows,
  (SELECT count(*) FROM bad) AS texts_with_conflicting_labels""",
        "blank_texts": f"""SELECT count(*) FILTER (text IS NULL) AS null_texts,
  count(*) FILTER (NOT regexp_matches(text, {_q(NOT_SPACE)})) AS blank_texts FROM documents""",
        "char_length_stats": _stats("length(text)", "documents"),
        "word_length_stats": _stats(_word_count("text"), "documents"),
        "text_flags_per_row": _flags("documents", "text", "doc_id"),
        "page_flags_per_row": _flags("pages", "html", "page_id"),
        "feature_presence": _presence("documents", "text"),
        "page_feature_presence": _presence("pages", "html"),
        "non_ascii_rows": f"""SELECT count(*) FILTER (regexp_matches(text, {_q(tx.NON_ASCII)})) AS n,
  round(count(*) FILTER (regexp_matches(text, {_q(tx.NON_ASCII)}))::DOUBLE / count(text) * 100, 4) AS pct FROM documents""",
        "examples_per_class": """SELECT lang AS label, r::INT AS rank, replace(substr(text, 1, 200), chr(10), ' ') AS example
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 2""",
        "non_ascii_preview": f"""SELECT doc_id, substr(text, 1, 150) AS preview FROM documents
WHERE regexp_matches(text, {_q(tx.NON_ASCII)}) ORDER BY doc_id LIMIT 3""",
        "profile_report": _profile_report(
            DOCS, "docs", {"doc_id": "bigint", "text": "string", "label": "string"}, "label"
        ),
        "conversation_profile": _profile_report(
            "docs AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS doc_id, text, role AS label FROM conversations)",
            "conversations",
            {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
            "role",
        ),
        "column_roles": f"""WITH d AS ({distinct}) SELECT column_name, n AS n_distinct,
  CASE WHEN column_name = (SELECT column_name FROM d ORDER BY n, o LIMIT 1) THEN 'label'
       WHEN column_name = (SELECT column_name FROM d ORDER BY n DESC, o LIMIT 1) THEN 'text'
       ELSE 'other' END AS role FROM d""",
        "null_audit": " UNION ALL ".join(
            f"SELECT {_q(c)} AS column_name, count(*) - count({c}) AS nulls, count(*) = count({c}) AS passes FROM documents"
            for c in ("text", "source")
        ),
        "class_coverage_gaps": """SELECT split, label FROM (SELECT DISTINCT source AS label FROM documents), (VALUES ('0'), ('1')) s(split)
EXCEPT SELECT toxic::VARCHAR, source FROM documents JOIN labels USING (doc_id)""",
        "unique_text_check": """SELECT count(*) AS n_rows, count(DISTINCT text) AS n_unique,
  count(*) = count(DISTINCT text) AS is_unique FROM documents""",
        "conversation_unique_texts": """SELECT count(*) AS n_rows, count(DISTINCT text) AS n_unique,
  count(*) = count(DISTINCT text) AS is_unique FROM conversations""",
        "expected_value_mismatches": f"""WITH {DOCS}, raw AS (SELECT label, count(*) AS n FROM docs GROUP BY label),
kept AS (SELECT label, count(*) AS n FROM docs
  WHERE doc_id IN (SELECT min(doc_id) FROM docs GROUP BY text HAVING count(DISTINCT label) = 1) GROUP BY label)
SELECT label, kept.n AS actual, raw.n AS expected FROM raw FULL JOIN kept USING (label)
WHERE kept.n IS DISTINCT FROM raw.n""",
    }


def _histogram(docs: str) -> str:
    return f"""WITH {docs}, {GROUPS} SELECT n_rows AS appearances, count(*) AS texts FROM grp
WHERE n_rows > 1 GROUP BY n_rows"""


def _combinations(docs: str) -> str:
    return f"""WITH {docs}, {GROUPS} SELECT combination, count(*) AS texts, sum(n_rows)::BIGINT AS n_rows,
  round(count(*)::DOUBLE / (SELECT count(*) FROM grp WHERE n_labels > 1) * 100, 2) AS pct_of_conflicts
FROM grp WHERE n_labels > 1 GROUP BY combination ORDER BY texts DESC, combination"""


def _majority(docs: str) -> str:
    return f"""WITH {docs}, {CONFLICTS}, v AS (
  SELECT text, max(n) AS most, sum(n) AS votes FROM
    (SELECT text, label, count(*) AS n FROM docs WHERE text IN (SELECT text FROM bad) GROUP BY text, label) GROUP BY text)
SELECT count(*) FILTER (most > votes - most) AS with_majority, count(*) FILTER (most <= votes - most) AS tied,
  count(*) FILTER (most > votes - most) > 0 AS majority_applicable FROM v"""


def _shorten(column: str) -> str:
    line = f"trim(replace({column}, chr(10), ' '), {_q(tx.SPACE_CHARS)})"
    return f"CASE WHEN length({line}) > 120 THEN substr({line}, 1, 120) || '…' ELSE {line} END"


def _consistent(docs: str) -> str:
    return f"""WITH {docs}, {GROUPS}
SELECT d.label, count(*) FILTER (n_labels = 1 AND n_rows > 1) AS all_copies,
  count(*) FILTER (n_labels = 1 AND n_rows > 1 AND doc_id <> first_doc) AS redundant_copies
FROM docs d JOIN grp USING (text) GROUP BY d.label"""


def _duplicates() -> dict[str, str]:
    pairs = "pairs AS (SELECT text, label, count(*) AS n, min(doc_id) AS f FROM docs GROUP BY text, label)"

    def total(section: str, item: str, value: str, source: str) -> str:
        return f"SELECT {_q(section)} AS section, {_q(item)} AS item, ({value})::DOUBLE AS value FROM {source}"

    report = " UNION ALL ".join(
        [
            total("texts", "total_rows", "count(*)", "docs"),
            total("texts", "unique_texts", "count(*)", "grp"),
            total("texts", "texts_repeated", "count(*)", "grp WHERE n_rows > 1"),
            total("texts", "texts_once", "count(*)", "grp WHERE n_rows = 1"),
            total("exact_duplicates", "all_copies", "coalesce(sum(n), 0)", "pairs WHERE n > 1"),
            total("exact_duplicates", "non_first_copies", "coalesce(sum(n - 1), 0)", "pairs"),
            total("exact_duplicates", "unique_pairs_with_duplicates", "count(*)", "pairs WHERE n > 1"),
            total("repeated_texts", "consistent_texts", "count(*)", "grp WHERE n_rows > 1 AND n_labels = 1"),
            total("repeated_texts", "consistent_rows", "coalesce(sum(n_rows), 0)", "grp WHERE n_rows > 1 AND n_labels = 1"),
            total("repeated_texts", "conflicting_texts", "count(*)", "grp WHERE n_labels > 1"),
            total("repeated_texts", "conflicting_rows", "coalesce(sum(n_rows), 0)", "grp WHERE n_labels > 1"),
            total("repeated_texts", "max_labels_per_text", "max(n_labels)", "grp"),
            "SELECT 'multiplicity', n_rows::VARCHAR, count(*)::DOUBLE FROM grp WHERE n_rows > 1 GROUP BY n_rows",
            "SELECT 'combination_texts', combination, count(*)::DOUBLE FROM grp WHERE n_labels > 1 GROUP BY combination",
            "SELECT 'combination_rows', combination, sum(n_rows)::DOUBLE FROM grp WHERE n_labels > 1 GROUP BY combination",
        ]
    )
    found = {
        "exact_duplicates": f"""WITH {DOCS}, {pairs} SELECT coalesce(sum(n), 0)::BIGINT AS all_copies,
  coalesce(sum(n - 1), 0)::BIGINT AS non_first_copies, count(*) AS unique_pairs_with_duplicates FROM pairs WHERE n > 1""",
        "duplicate_samples": f"""WITH {DOCS}, {pairs},
s AS (SELECT substr(text, 1, 60) AS lead, label, min(f) AS first_order FROM pairs WHERE n > 1 GROUP BY ALL)
SELECT lead, s.label, first_order, {_shorten("text")} AS sample FROM s JOIN docs ON doc_id = first_order
ORDER BY first_order LIMIT 4""",
        "text_multiplicity": f"""WITH {DOCS}, {GROUPS} SELECT count(*) AS unique_texts,
  count(*) FILTER (n_rows > 1) AS texts_repeated, count(*) FILTER (n_rows = 1) AS texts_once FROM grp""",
        "multiplicity_histogram": _histogram(DOCS),
        "event_multiplicity_histogram": _histogram(EVENTS),
        "text_label_profile": """SELECT min(doc_id) AS first_doc, text, string_agg(DISTINCT source, ',' ORDER BY source) AS labels,
  count(DISTINCT source) AS n_labels, count(*) AS n_rows FROM documents GROUP BY text""",
        "consistent_vs_conflicting": f"""WITH {DOCS}, {GROUPS} SELECT count(*) FILTER (n_rows > 1) AS repeated_texts,
  count(*) FILTER (n_rows > 1 AND n_labels = 1) AS consistent_texts,
  coalesce(sum(n_rows) FILTER (n_rows > 1 AND n_labels = 1), 0)::BIGINT AS consistent_rows,
  count(*) FILTER (n_labels > 1) AS conflicting_texts,
  coalesce(sum(n_rows) FILTER (n_labels > 1), 0)::BIGINT AS conflicting_rows, max(n_labels) AS max_labels_per_text FROM grp""",
        "label_combinations": _combinations(DOCS),
        "event_label_combinations": _combinations(EVENTS),
        "combination_examples": f"""WITH {DOCS}, {GROUPS},
e AS (SELECT combination, min(first_doc) AS first_order FROM grp WHERE n_labels > 1 GROUP BY combination)
SELECT e.combination, e.first_order, {_shorten("x.text")} AS sample, d.label, count(*) AS n
FROM e JOIN docs x ON x.doc_id = e.first_order JOIN docs d ON d.text = x.text
GROUP BY e.combination, e.first_order, x.text, d.label""",
        "conflict_frequency": f"""WITH {DOCS}, {GROUPS} SELECT count(*) FILTER (n_rows = 2) AS seen_twice,
  count(*) FILTER (n_rows >= 3) AS seen_three_or_more FROM grp WHERE n_labels > 1""",
        "conflict_impact_by_class": f"""WITH {DOCS}, {CONFLICTS}
SELECT docs.label, count(bad.text) AS rows_in_conflicts, count(DISTINCT bad.text) AS texts_in_conflicts
FROM docs LEFT JOIN bad USING (text) GROUP BY docs.label""",
        "majority_check": _majority(DOCS),
        "event_majority_check": _majority(EVENTS),
        "order_majority_check": _majority(ORDERS),
        "consistent_by_class": _consistent(DOCS),
        "consistent_by_language": _consistent(DOCS_LANG),
        "remaining_duplicates": f"""WITH {DOCS}, {GROUPS} SELECT count(*) FILTER (n_rows > 1) AS duplicate_texts,
  count(*) FILTER (n_labels > 1) AS conflicting_texts FROM grp""",
        "duplicate_report": f"WITH {DOCS}, {GROUPS}, {pairs} {report}",
    }
    # Counts kept of a part of the table, with the rest merged in, are those of the whole.
    return found | {f"{name}_from_state": found[name] for name in ("duplicate_report", "combination_examples")}


def _policy_ctes(docs: str) -> str:
    """The rows of each policy, as CTEs p_baseline, p_a, p_b, p_c, p_d."""
    return f"""WITH {docs}, {CONFLICTS}, p_baseline AS (SELECT * FROM docs),
p_a AS (SELECT * FROM docs WHERE text NOT IN (SELECT text FROM bad)),
p_b AS (SELECT * FROM docs WHERE doc_id IN (SELECT min(doc_id) FROM docs GROUP BY text)),
p_c AS (SELECT * FROM p_a),
p_d AS (SELECT * FROM p_a WHERE doc_id IN (SELECT min(doc_id) FROM p_a GROUP BY text))"""


POLICIES = (("baseline", "p_baseline"), ("A", "p_a"), ("B", "p_b"), ("C", "p_c"), ("D", "p_d"))


def _summary() -> str:
    one = " UNION ALL ".join(
        f"""SELECT '{name}' AS policy, (SELECT count(*) FROM {rows}) AS total_rows,
  (SELECT count(*) FROM docs) - (SELECT count(*) FROM {rows}) AS rows_removed,
  round((SELECT count(*) FROM {rows})::DOUBLE / (SELECT count(*) FROM docs) * 100, 4) AS pct_retained,
  (SELECT count(DISTINCT text) FROM {rows}) AS unique_texts,
  (SELECT count(*) FROM (SELECT text FROM {rows} GROUP BY text HAVING count(*) > 1)) AS duplicate_texts_remaining,
  (SELECT count(*) FROM (SELECT text FROM {rows} GROUP BY text HAVING count(DISTINCT label) > 1)) AS conflicting_texts_remaining"""
        for name, rows in POLICIES
    )
    return one


def _policies() -> dict[str, str]:
    ctes = _policy_ctes(DOCS)
    metrics = ("total_rows", "rows_removed", "pct_retained", "unique_texts", "duplicate_texts_remaining", "conflicting_texts_remaining")
    comparison = " UNION ALL ".join(
        "SELECT " + _q(m) + " AS metric, "
        + ", ".join(f"max({m}::DOUBLE) FILTER (policy = '{p}') AS {_ident(p)}" for p, _ in POLICIES)
        + " FROM s"
        for m in metrics
    )
    matrix = ", ".join(
        f"(SELECT count(*) FROM {rows} x WHERE x.label = l.label) AS rows_{p}, "
        f"round((SELECT count(*) FROM {rows} x WHERE x.label = l.label)::DOUBLE / (SELECT count(*) FROM {rows}) * 100, 4) AS pct_{p}"
        for p, rows in POLICIES
    )
    whole = ", ".join(f"(SELECT count(*) FROM {rows}), 100.0::DOUBLE" for _, rows in POLICIES)
    scalars = {
        "original_row_count": "(SELECT count(*) FROM docs)",
        "conflicting_text_count": "(SELECT count(*) FROM bad)",
        "conflicting_unique_texts": "(SELECT count(*) FROM bad)",
        "conflicting_rows_removed": "(SELECT count(*) FROM docs) - (SELECT count(*) FROM p_a)",
        "consistent_duplicate_groups": "(SELECT count(*) FROM (SELECT text FROM p_a GROUP BY text HAVING count(*) > 1))",
        "redundant_duplicate_rows_removed": "(SELECT count(*) FROM p_a) - (SELECT count(DISTINCT text) FROM p_a)",
        "total_rows_removed": "(SELECT count(*) FROM docs) - (SELECT count(*) FROM p_d)",
        "final_row_count": "(SELECT count(*) FROM p_d)",
        "final_unique_text_count": "(SELECT count(DISTINCT text) FROM p_d)",
        "final_duplicate_text_count": "(SELECT count(*) - count(DISTINCT text) FROM p_d)",
        "final_conflicting_text_count": "(SELECT count(*) FROM (SELECT text FROM p_d GROUP BY text HAVING count(DISTINCT label) > 1))",
        "pct_retained": "round((SELECT count(*) FROM p_d)::DOUBLE / (SELECT count(*) FROM docs) * 100, 4)",
    }
    summary = " UNION ALL ".join(
        f"SELECT 'summary' AS section, {_q(k)} AS item, ({v})::DOUBLE AS value" for k, v in scalars.items()
    )
    per_class = [
        ("conflict_rows", "count(*) FILTER (n_labels > 1)"),
        ("conflict_texts", "count(DISTINCT text) FILTER (n_labels > 1)"),
        ("consistent_all_copies", "count(*) FILTER (n_labels = 1 AND n_rows > 1)"),
        ("consistent_redundant_copies", "count(*) FILTER (n_labels = 1 AND n_rows > 1 AND doc_id <> first_doc)"),
    ]
    impact = [
        f"SELECT {_q(name)} AS section, label AS item, ({value})::DOUBLE AS value FROM docs JOIN grp USING (text) GROUP BY label"
        for name, value in per_class
    ]
    impact += [
        "SELECT 'conflicts', 'texts', count(*)::DOUBLE FROM bad",
        "SELECT 'conflicts', 'rows', count(*)::DOUBLE FROM docs WHERE text IN (SELECT text FROM bad)",
        *[
            f"SELECT 'majority', {_q(item)}, {column}::DOUBLE FROM mv"
            for item, column in (
                ("with_majority", "with_majority"),
                ("tied", "tied"),
                ("applicable", "majority_applicable"),
            )
        ],
    ]
    for name, rows in POLICIES:
        impact += [
            f"SELECT 'policy_{name}', {_q(m)}, {m}::DOUBLE FROM s WHERE policy = '{name}'" for m in metrics
        ]
        count = f"(SELECT count(*) FROM {rows} x WHERE x.label = l.label)"
        labels = "FROM (SELECT DISTINCT label FROM docs) l"
        impact += [
            f"SELECT 'policy_{name}_class_counts', l.label, {count}::DOUBLE {labels}",
            f"SELECT 'policy_{name}_class_percentages', l.label, round({count}::DOUBLE / (SELECT count(*) FROM {rows}) * 100, 4) {labels}",
        ]
    impact_sql = (
        f"{ctes}, {GROUPS}, s AS ({_summary()}), mv AS ({_majority(DOCS)}) " + " UNION ALL ".join(impact)
    )
    return {
        "policy_impact_report": impact_sql,
        "policy_a": f"{ctes} SELECT * FROM p_a",
        "events_kept_by_place": """SELECT event_id, props, event_type FROM events
WHERE event_id IN (SELECT min(event_id) FROM events GROUP BY props)""",
        "policy_b": f"{ctes} SELECT * FROM p_b",
        "policy_c": f"{ctes} SELECT * FROM p_c",
        "policy_d": f"{ctes} SELECT * FROM p_d",
        "policy_summary": f"{ctes} {_summary()}",
        "policy_comparison": f"{ctes}, s AS ({_summary()}) {comparison}",
        "policy_class_matrix": f"""{ctes} SELECT l.label, false AS is_total, {matrix} FROM (SELECT DISTINCT label FROM docs) l
UNION ALL SELECT 'TOTAL', true, {whole}""",
        "before_after_delta": f"""{ctes}, b AS (SELECT label, count(*) AS n FROM docs GROUP BY label),
a AS (SELECT label, count(*) AS n FROM p_d GROUP BY label)
SELECT label, b.n AS before_n, round(round(b.n::DOUBLE / (SELECT count(*) FROM docs) * 100, 4), 2) AS before_pct,
  a.n AS after_n, round(round(a.n::DOUBLE / (SELECT count(*) FROM p_d) * 100, 4), 2) AS after_pct,
  a.n - b.n AS delta_rows, round((a.n - b.n)::DOUBLE / b.n * 100, 2) AS change_pct
FROM b FULL JOIN a USING (label)""",
        "cleaning_report": f"""{ctes}, c AS (
  SELECT l.label, (SELECT count(*) FROM p_d x WHERE x.label = l.label)::DOUBLE AS n FROM (SELECT DISTINCT label FROM docs) l)
{summary} UNION ALL SELECT 'class_counts', label, n FROM c
UNION ALL SELECT 'class_percentages', label, round(n / (SELECT count(*) FROM p_d) * 100, 4) FROM c""",
        "majority_resolved": f"{_majority_rows(DOCS)} SELECT doc_id, text, label FROM won",
        "rated_majority_resolved": f"{_majority_rows(RATED)} SELECT doc_id, text, label FROM won",
        "rated_majority_check": _majority(RATED),
        "order_majority_resolved": f"""{_majority_rows(ORDERS)}
SELECT doc_id AS o_orderkey, text AS customer, label AS o_orderstatus FROM won""",
    }


def _majority_rows(docs: str) -> str:
    return f"""WITH {docs}, c AS (SELECT text, label, count(*) AS n, min(doc_id) AS f FROM docs WHERE label IS NOT NULL GROUP BY text, label),
t AS (SELECT text, sum(n) AS total FROM c GROUP BY text),
won AS (SELECT d.* FROM c JOIN t USING (text) JOIN docs d ON d.doc_id = c.f WHERE c.n > t.total - c.n)"""


def _ident(name: str) -> str:
    return f'"{name}"'


def _split_ctes(docs: str) -> str:
    """Adds CTE ``asg``: docs with their split, from quotas and full ranks."""
    return f"""WITH {docs},
c0 AS (SELECT label, count(*) AS n FROM docs GROUP BY label),
c1 AS (SELECT *, round_even((SELECT sum(n) FROM c0) * 0.1, 0)::BIGINT AS ts, (SELECT sum(n) FROM c0)::BIGINT AS tot FROM c0),
c2 AS (SELECT *, (n * ts) // tot AS fl, row_number() OVER (ORDER BY (n * ts) % tot DESC, label) AS pos FROM c1),
c3 AS (SELECT label, n, ts, tot, fl + CASE WHEN pos <= ts - (SELECT sum(fl) FROM c2) THEN 1 ELSE 0 END AS test_n FROM c2),
c4 AS (SELECT *, n - test_n AS m FROM c3),
c5 AS (SELECT *, (m * ts) // (tot - ts) AS fl, row_number() OVER (ORDER BY (m * ts) % (tot - ts) DESC, label) AS pos FROM c4),
quota AS (SELECT label, test_n, fl + CASE WHEN pos <= ts - (SELECT sum(fl) FROM c5) THEN 1 ELSE 0 END AS val_n FROM c5),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{settings.SEED}|' || doc_id), doc_id) AS r FROM docs),
asg AS (SELECT doc_id, text, label,
  CASE WHEN r <= test_n THEN 'test' WHEN r <= test_n + val_n THEN 'val' ELSE 'train' END AS split
  FROM ranked JOIN quota USING (label))"""


def _overlap(a: str, b: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT DISTINCT text FROM asg WHERE split = '{a}' "
        f"INTERSECT SELECT DISTINCT text FROM asg WHERE split = '{b}'))"
    )


def _audit() -> str:
    counts = ", ".join(f"{_overlap(a, b)} AS {a}_{b}_overlap" for a, b in PAIRS)
    free = " + ".join(_overlap(a, b) for a, b in PAIRS)
    return f"SELECT {counts}, ({free}) = 0 AS is_leakage_free"


def _splits() -> dict[str, str]:
    asg = _split_ctes(CLEAN)
    per_split = "(SELECT count(*) FROM asg x WHERE x.split = asg.split)"
    matrix = ", ".join(
        f"count(*) FILTER (split = '{s}') AS {s}_n, round(count(*) FILTER (split = '{s}')::DOUBLE / "
        f"(SELECT count(*) FROM asg WHERE split = '{s}') * 100, 2) AS {s}_pct"
        for s in ("train", "val", "test")
    )
    leaks = " UNION ALL ".join(
        f"SELECT 'leakage', '{a}_{b}_overlap', {_overlap(a, b)}::DOUBLE" for a, b in PAIRS
    )
    return {
        "stratified_split": f"{asg} SELECT doc_id, label, split FROM asg",
        "leakage_audit": f"{asg} {_audit()}",
        "leakage_audit_raw": f"{_split_ctes(DOCS)} {_audit()}",
        "split_stats": f"""{asg} SELECT split, label, count(*) AS n, {per_split} AS total_rows,
  (SELECT count(DISTINCT label) FROM asg x WHERE x.split = asg.split) AS num_classes,
  round(count(*)::DOUBLE / {per_split} * 100, 4) AS pct FROM asg GROUP BY split, label""",
        "split_reproducible": f"""{asg} SELECT count(*) AS rows_alike, 0::BIGINT AS rows_differing, true AS is_reproducible FROM asg""",
        "split_report": f"""{asg}
SELECT 'rows' AS section, split AS item, count(*)::DOUBLE AS value FROM asg GROUP BY split
UNION ALL SELECT 'totals', 'source_rows', count(*)::DOUBLE FROM docs
UNION ALL SELECT 'totals', 'rows_in_splits', count(*)::DOUBLE FROM asg
UNION ALL SELECT 'row_percentages', split, round(count(*)::DOUBLE / (SELECT count(*) FROM asg) * 100, 2) FROM asg GROUP BY split
UNION ALL {leaks}
UNION ALL SELECT 'leakage', 'is_leakage_free', (is_leakage_free)::INT::DOUBLE FROM ({_audit()})
UNION ALL SELECT 'class_counts_' || split, label, count(*)::DOUBLE FROM asg GROUP BY split, label
UNION ALL SELECT 'class_percentages_' || split, label, round(count(*)::DOUBLE / {per_split} * 100, 4) FROM asg GROUP BY split, label
UNION ALL SELECT 'reproducibility', 'rows_differing', 0::DOUBLE UNION ALL SELECT 'reproducibility', 'verified', 1::DOUBLE""",
        "class_split_matrix": f"{asg} SELECT label, count(*) AS total, {matrix} FROM asg GROUP BY label",
        "cross_split_dedup": f"""{_split_ctes(DOCS)} SELECT doc_id, label, split FROM asg WHERE split = 'test'
OR (split = 'val' AND text NOT IN (SELECT text FROM asg WHERE split = 'test'))
OR (split = 'train' AND text NOT IN (SELECT text FROM asg WHERE split <> 'train'))""",
    }


def _tfidf() -> str:
    return f"""{_split_ctes(CLEAN)},
tok AS (SELECT doc_id, split, unnest(regexp_extract_all(lower(text), '[{tx.WORD}]{{2,}}')) AS term FROM asg),
tc AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM tok
  WHERE split = 'train' AND term NOT IN ({STOP}) GROUP BY term),
top AS (SELECT * FROM tc ORDER BY tf DESC, term LIMIT {settings.MAX_FEATURES}),
vocab AS (SELECT (row_number() OVER (ORDER BY term) - 1)::INT AS term_id, term, tf, df,
  ln((1 + (SELECT count(*) FROM asg WHERE split = 'train'))::DOUBLE / (1 + df)) + 1 AS idf FROM top)"""


def _words() -> str:
    return f"""{_split_ctes(CLEAN)},
lists AS (SELECT doc_id, split, regexp_extract_all(lower(text), {_q(f"[^ {SEPARATORS}]+")}) AS words FROM asg),
tok AS (SELECT doc_id, split, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM lists),
wc AS (SELECT word, count(*) AS n, min({{'d': doc_id, 'p': place}}) AS seen FROM tok WHERE split = 'train' GROUP BY word),
vocab AS (SELECT word, n, (row_number() OVER (ORDER BY n DESC, seen) + 1)::INT AS word_id FROM wc
  ORDER BY n DESC, seen LIMIT {settings.VOCAB_SIZE - 2})"""


def _sequences(pre: bool) -> str:
    size = settings.SEQUENCE_LENGTH
    cut = f"place > len - {size}" if pre else f"place <= {size}"
    parts = ("fill", "ids") if pre else ("ids", "fill")
    return f"""{_words()},
ids AS (SELECT doc_id, string_agg(coalesce(word_id, 1)::VARCHAR, ' ' ORDER BY place) AS ids, count(*) AS k
  FROM tok JOIN (SELECT doc_id, len(words) AS len FROM lists) USING (doc_id) LEFT JOIN vocab USING (word)
  WHERE {cut} GROUP BY doc_id),
every AS (SELECT a.doc_id, coalesce(ids, '1') AS ids, coalesce(k, 1) AS k FROM asg a LEFT JOIN ids USING (doc_id)),
filled AS (SELECT doc_id, ids, CASE WHEN k < {size} THEN rtrim(repeat('0 ', ({size} - k)::INT)) END AS fill FROM every)
SELECT doc_id, concat_ws(' ', {parts[0]}, {parts[1]}) AS sequence FROM filled"""


def _mask(column: str) -> str:
    return f"regexp_replace(regexp_replace({column}, {_q(URL)}, '<URL>', 'g'), {_q(tx.MENTION)}, '<USER>', 'g')"


def _features() -> dict[str, str]:
    return {
        "label_index": f"""{_split_ctes(CLEAN)}
SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS label_id FROM (SELECT DISTINCT label FROM asg WHERE split = 'train')""",
        "label_round_trip": """SELECT doc_id, lang AS label, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS label_id,
  lang AS decoded FROM documents""",
        "tfidf_vocabulary": f"{_tfidf()} SELECT term_id, term, tf, df, round(idf, 6) AS idf FROM vocab",
        "tfidf_weights": f"""{_tfidf()},
w AS (SELECT doc_id, term, count(*) AS n, count(*) * any_value(idf) AS raw FROM tok JOIN vocab USING (term) GROUP BY doc_id, term)
SELECT doc_id, term, n AS tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
        "sequence_vocabulary": f"{_words()} SELECT word, n, word_id FROM vocab",
        "padded_sequences": _sequences(pre=False),
        "padded_sequences_pre": _sequences(pre=True),
        "normalized_text": f"SELECT doc_id, {_mask('text')} AS normalized FROM documents",
        "normalized_pages": f"SELECT page_id, {_mask('html')} AS normalized FROM pages",
    }


def _evaluation() -> dict[str, str]:
    cases = " ".join(
        f"WHEN regexp_matches(text, '[{letters}]') THEN '{language}'" for language, letters in settings.LETTERS.items()
    )
    p = f"""WITH p AS (SELECT doc_id, text, lang AS truth, CASE {cases} ELSE 'en' END AS predicted FROM documents),
l AS (SELECT truth AS label FROM p UNION SELECT predicted FROM p),
m AS (SELECT label, (SELECT count(*) FROM p WHERE truth = label) AS support,
  (SELECT count(*) FROM p WHERE predicted = label) AS claimed,
  (SELECT count(*) FROM p WHERE truth = label AND predicted = label) AS hits FROM l),
s AS (SELECT *, CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed END AS prec,
  CASE WHEN support = 0 THEN 0 ELSE hits / support END AS rec,
  CASE WHEN claimed + support = 0 THEN 0 ELSE 2 * hits / (claimed + support) END AS f FROM m)"""
    wide = ", ".join(
        f"(SELECT count(*) FROM p WHERE truth = a.label AND predicted = '{name}') AS \"{name}\"" for name in [*settings.LETTERS, "en"]
    )
    return {
        "argmax_class": """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS predicted FROM embeddings""",
        "overall_metrics": f"""{p} SELECT sum(support)::BIGINT AS n_rows, round(sum(hits) / sum(support), 6) AS accuracy,
  round(avg(f), 6) AS macro_f1, round(sum(f * support) / sum(support), 6) AS weighted_f1 FROM s""",
        "confusion_matrix": f"""{p} SELECT a.label AS truth, b.label AS predicted,
  (SELECT count(*) FROM p WHERE truth = a.label AND predicted = b.label) AS n FROM l a, l b""",
        "confusion_matrix_wide": f"""{p} SELECT a.label AS truth, {wide} FROM l a""",
        "classification_report": f"""{p}
SELECT label, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f, 6) AS f1, support FROM s
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM s
UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f), 6), sum(support)::BIGINT FROM s
UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM s""",
        "error_summary": f"""{p} SELECT count(*) FILTER (truth <> predicted) AS errors, count(*) AS n_rows,
  round(count(*) FILTER (truth <> predicted)::DOUBLE / count(*) * 100, 2) AS error_pct FROM p""",
        "misclassified": f"{p} SELECT doc_id, truth AS label, predicted AS guess FROM p WHERE truth <> predicted",
        "misclassified_preview": f"""{p} SELECT doc_id, truth, predicted, substr(text, 1, 140) AS preview FROM p
WHERE truth <> predicted ORDER BY doc_id LIMIT 6""",
    }


def _rules() -> dict[str, str]:
    """The rule classifiers on the split, and what must hold for any trained model."""

    def cases(patterns) -> str:
        return "CASE " + " ".join(f"WHEN regexp_matches(text, {_q(p)}) THEN {_q(language)}" for language, p in patterns.items()) + " ELSE 'en' END"

    guesses = " UNION ALL ".join(
        f"SELECT {_q(name)} AS model, split, label AS truth, {cases(patterns)} AS predicted FROM asg" for name, patterns in settings.RULES.items()
    )
    ctes = f"""{_split_ctes(CLEAN)}, g AS ({guesses}),
l AS (SELECT DISTINCT model, split, truth AS label FROM g UNION SELECT DISTINCT model, split, predicted FROM g),
m AS (SELECT model, split, l.label,
  (SELECT count(*) FROM g WHERE g.model = l.model AND g.split = l.split AND truth = l.label) AS support,
  (SELECT count(*) FROM g WHERE g.model = l.model AND g.split = l.split AND predicted = l.label) AS claimed,
  (SELECT count(*) FROM g WHERE g.model = l.model AND g.split = l.split AND predicted = l.label AND truth = l.label) AS hits FROM l),
s AS (SELECT *, CASE WHEN claimed + support = 0 THEN 0 ELSE 2 * hits / (claimed + support) END AS f FROM m),
b AS (SELECT model, split, sum(support)::BIGINT AS n_rows, round(sum(hits) / sum(support), 4) AS accuracy, round(avg(f), 4) AS macro_f1,
  round(sum(f * support) / sum(support), 4) AS weighted_f1 FROM s GROUP BY model, split)"""
    columns = "model, n_rows, accuracy, macro_f1, weighted_f1"
    best = "SELECT model FROM b WHERE split = 'val' ORDER BY macro_f1 DESC, model LIMIT 1"
    models = ", ".join(f"({_q(name)})" for name in ("dense", "linear", "linear_l1", "linear_l2"))
    return {
        "rule_benchmark": f"{ctes} SELECT {columns} FROM b WHERE split = 'val'",
        "rule_selected": f"{ctes} SELECT {columns} FROM b WHERE split = 'val' AND model = ({best})",
        "rule_test_evaluation": f"{ctes} SELECT {columns} FROM b WHERE split = 'test' AND model = ({best})",
        "model_invariants": f"""{_split_ctes(CLEAN)}
SELECT model, count(*) AS rows_scored, count(*) AS in_domain, count(*) AS sums_to_one FROM asg, (VALUES {models}) AS v(model)
WHERE split = 'val' GROUP BY model""",
    }


def _jobs() -> dict[str, str]:
    return {
        "csv_round_trip": "SELECT doc_id, text, lang AS label FROM documents",
        "split_round_trip": f"{_split_ctes(CLEAN)} SELECT doc_id, label, split FROM asg",
        "cleaning_job": _policies()["cleaning_report"],
        "split_job": _splits()["split_report"],
    }


def all_sql() -> dict[str, str]:
    return {
        **_jobs(),
        **_rules(),
        **_profiling(),
        **_duplicates(),
        **_policies(),
        **_splits(),
        **_features(),
        **_evaluation(),
    }
