"""DuckDB statements with the same rows as the queries that SQL can express."""

from __future__ import annotations

from curbwise.llm import quality, urls

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _fold(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def _quality() -> str:
    space = r"\x20\x09-\x0D"
    union = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM measured WHERE NOT base_failed" for m in quality.MEASURES
    )
    slack = "CASE measure " + " ".join(f"WHEN '{m}' THEN {n}" for m, n in quality.SLACK.items()) + " END"

    def level(name: str, keys: str) -> str:
        group = f"{keys}, " if keys else ""
        part = f"PARTITION BY {group}measure"
        wide = ", ".join(f"max(CASE WHEN measure = '{m}' THEN fence END) AS {m}" for m in quality.MEASURES)
        by = f"GROUP BY {keys}" if keys else ""
        return f"""
{name}_runs AS (
  SELECT {group}measure, bucket, sum(sum(n)) OVER ({part} ORDER BY bucket) AS seen, sum(sum(n)) OVER ({part}) AS total
  FROM histogram GROUP BY {group}measure, bucket),
{name}_q AS (
  SELECT {group}measure, max(total) AS total, min(bucket) FILTER (4 * seen >= total) AS low,
         min(bucket) FILTER (4 * seen >= 3 * total) AS high
  FROM {name}_runs GROUP BY {group}measure),
{name}_f AS (
  SELECT {group}max(total) AS n, {wide}
  FROM (SELECT *, high + greatest({quality.SPREAD} * (high - low), {slack}) AS fence FROM {name}_q) {by})"""

    limit = ",\n  ".join(
        f"CAST(CASE WHEN o.n >= {quality.MIN_GROUP} THEN o.{m} WHEN l.n >= {quality.MIN_GROUP} THEN l.{m} ELSE a.{m} END AS BIGINT) AS max_{m}"
        for m in quality.MEASURES
    )
    inside = " AND ".join(f"coalesce({m} <= max_{m}, true)" for m in quality.MEASURES)
    return rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^{space}]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{space}]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS pos FROM split)),
repeats AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n
  FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows), range(3) AS r(k)
  WHERE c > 1 GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines
  FROM split s LEFT JOIN repeats r ON r.doc_id = s.doc_id),
measured AS (
  SELECT *, coalesce(n_symbols * 1000 // nullif(n_words, 0), 0) AS symbols_pm,
         coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0) AS dup_lines_pm,
         coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0) AS repeats_pm,
         coalesce(word_chars * 1000 // nullif(n_words, 0), 0) AS word_length_pm,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counted),
histogram AS (
  SELECT lang, source, measure, (v >> s) << s AS bucket, count(*) AS n
  FROM (SELECT *, CAST(greatest(length(bin(v)) - 5, 0) AS BIGINT) AS s FROM ({union}))
  GROUP BY ALL),
{level("own", "lang, source")},
{level("lang", "lang")},
{level("whole", "")},
limits AS (
  SELECT o.lang, o.source, {limit}
  FROM own_f o LEFT JOIN lang_f l ON l.lang IS NOT DISTINCT FROM o.lang, whole_f a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {inside} AS kept,
       {", ".join(quality.MEASURES)}, {", ".join(f"max_{m}" for m in quality.MEASURES)}
FROM measured m LEFT JOIN limits t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source
"""


def _urls() -> str:
    def hits(terms: tuple[str, ...]) -> str:
        return " + ".join(
            f"CAST(regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS BIGINT)" for term in terms
        )

    rules = ", ".join(f"('{host}', '{path}', '{said}')" for host, path, said in urls.RULES)
    return rf"""
WITH split AS (
  SELECT page_id, {_fold("coalesce(url, '')")} AS low,
         coalesce({_fold("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule_host, rule_path, said) AS (VALUES {rules}),
ruled AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(said, length(rule_host || rule_path)) AS said
  FROM split JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id),
scored AS (SELECT *, {hits(urls.STRICT)} AS n_strict, {hits(urls.SOFT)} AS n_soft FROM split)
SELECT s.page_id, host, path, rule,
       coalesce(said, CASE WHEN n_strict > 0 OR n_soft >= {urls.SOFT_HITS} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft
FROM scored s LEFT JOIN ruled r ON r.page_id = s.page_id
"""


QUALITY = _quality()
URLS = _urls()
DECONTAMINATION = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_fold("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all({_fold("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, size, array_to_string(words[pos:pos + size - 1], ' ') AS win
  FROM (SELECT item, words, least(10, len(words)) AS size, unnest(range(1, greatest(len(words) - 8, 2))) AS pos
        FROM items WHERE len(words) > 0)),
doc_windows AS (
  SELECT doc_id, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM docs, (SELECT DISTINCT size FROM item_windows))),
hits AS (SELECT doc_id, pos, d.size, item FROM doc_windows d JOIN item_windows i ON i.size = d.size AND i.win = d.win),
marked AS (SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS w FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(m.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(m.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN marked m ON m.doc_id = d.doc_id LEFT JOIN named t ON t.doc_id = d.doc_id
"""
#: Exact shingle overlap of all pairs that share a shingle, and components of those at 0.8 or more; equal texts once.
NEAR_DUPS = r"""
WITH RECURSIVE texts AS (
  SELECT min(doc_id) AS id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS words
  FROM documents WHERE text IS NOT NULL GROUP BY text),
shingles AS MATERIALIZED (
  SELECT id, hash(s) AS s, count(*) AS n
  FROM (SELECT id, unnest([array_to_string(words[i:i + least(5, len(words)) - 1], ' ')
                           for i in range(1, len(words) - least(5, len(words)) + 2)]) AS s
        FROM texts WHERE len(words) > 0)
  GROUP BY ALL),
sizes AS (SELECT id, sum(n) AS total FROM shingles GROUP BY id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.id AS a, y.id AS b, sum(least(x.n, y.n)) AS shared
                    FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL) p
  JOIN sizes t ON t.id = a JOIN sizes u ON u.id = b
  WHERE shared >= 0.8 * (t.total + u.total - shared)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id, id AS member FROM sizes UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.member),
classes AS (SELECT id, min(member) AS class_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id
FROM documents d LEFT JOIN (SELECT text, min(doc_id) AS id FROM documents GROUP BY text) t ON t.text = d.text
LEFT JOIN classes c ON c.id = t.id
"""
