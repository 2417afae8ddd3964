"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from . import fill_middle, quality_rules, secret_scan

SPACES = r"[\x20\x09-\x0D]+"

#: Rows by number, with their words.
WORDS = rf"""
rows AS (
  SELECT row_number() OVER () AS rid, d.*, coalesce(text, '') AS t FROM documents AS d
), worded AS (
  SELECT *, list_filter(string_split_regex(t, '{SPACES}'), lambda x: x <> '') AS words FROM rows
)"""


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secret_scan_sql() -> str:
    parts = []
    for i, rule in enumerate(secret_scan.RULES):
        pattern = _text(rule.pattern)
        parts.append(f"""
  SELECT rid, {i} AS ord, '{rule.kind}' AS kind, k,
         list_sum([length(x) FOR x IN gaps[1:k]]) + coalesce(list_sum([length(x) FOR x IN hits[1:k-1]]), 0) AS start,
         length(hits[k]) AS size, length(regexp_extract(hits[k], {pattern}, {rule.group})) >= {rule.min_length} AS ok
  FROM (SELECT rid, regexp_extract_all(t, {pattern}) AS hits, string_split_regex(t, {pattern}) AS gaps FROM rows),
       unnest(range(1, len(hits) + 1)) AS place(k)""")
    n = len(secret_scan.BASE)
    return f"""
WITH {WORDS}, spans AS ({" UNION ALL ".join(parts)}
), named AS (
  SELECT rid, ord, CAST(start AS BIGINT) AS start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS span
  FROM spans WHERE ok
)
SELECT any_value(r.doc_id) AS doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access,
       count(*) FILTER (ord = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (ord < {n}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, ord), '') AS spans
FROM rows AS r LEFT JOIN named USING (rid) GROUP BY rid
"""


def _distance(p: str, q: str) -> str:
    half = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({0} + {1}) / 2)) ELSE 0 END"
    a, b = f"{p}[i]", f"{q}[i]"
    return (f"sqrt(greatest(list_sum([({half.format(a, b)} + {half.format(b, a)}) / 2 "
            f"FOR i IN range(1, len({q}) + 1)]), 0))")


def quality_rules_sql(limits: quality_rules.Limits = quality_rules.Limits(),
                      fit: quality_rules.Fit = quality_rules.Fit()) -> str:
    stated = ", ".join(f"('{lang}', {[*r.words]}, {[*r.shares]}, {[*r.classes]})"
                       for lang, r in quality_rules.STATED.items())
    marks = _text(quality_rules.PUNCTUATION.replace(r"\'", "'"))
    return rf"""
WITH {WORDS}, sample AS (
  SELECT DISTINCT doc_id, md5(CAST(doc_id AS VARCHAR)) AS h FROM labels WHERE quality = 1 AND doc_id IS NOT NULL
  ORDER BY h, doc_id LIMIT {fit.sample}
), good AS (
  SELECT lang, t, words, length(t) AS chars, coalesce(list_sum([length(x) FOR x IN words]), 0) AS word_chars,
         regexp_replace(t, '[\p{{L}}\x20\x09-\x0D]+', '', 'g') AS rest
  FROM worded WHERE lang IS NOT NULL AND doc_id IN (SELECT doc_id FROM sample)
), total AS (
  SELECT lang, sum(len(words)) AS n_words, sum(chars) AS chars, sum(word_chars) AS word_chars, sum(length(rest)) AS rest,
         sum(length(rest) - length(regexp_replace(rest, '\p{{N}}+', '', 'g'))) AS digits,
         sum(length(rest) - length(regexp_replace(rest, {marks}, '', 'g'))) AS marks
  FROM good GROUP BY lang HAVING count(*) >= {fit.min_docs} AND sum(len(words)) > 0
), top AS (
  SELECT lang, w, count(*) AS n FROM (SELECT lang, lower(unnest(words)) AS w FROM good) GROUP BY lang, w
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) <= {fit.common}
), fitted AS (
  SELECT lang, list(w ORDER BY n DESC, w) AS common,
         list_concat(list(n / n_words ORDER BY n DESC, w), [(any_value(n_words) - sum(n)) / any_value(n_words)]) AS word_ref,
         [x / any_value(chars) FOR x IN [any_value(word_chars - rest), any_value(digits), any_value(chars - word_chars),
                                         any_value(marks), any_value(rest - digits - marks)]] AS char_ref
  FROM top JOIN total USING (lang) GROUP BY lang
), stated(lang, common, word_ref, char_ref) AS (VALUES {stated}
), reference AS (
  SELECT * FROM fitted UNION ALL SELECT * FROM stated WHERE lang NOT IN (SELECT lang FROM fitted)
), windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM worded, unnest(range(1, len(words) - 1)) AS place(i)
), twice AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2]) AS step(k) GROUP BY rid
), counted AS (
  SELECT d.rid, d.doc_id, len(words) AS n_words, coalesce(list_sum([length(x) FOR x IN words]), 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
         coalesce(covered.n, 0) AS n_repeat_words, length(t) AS chars,
         regexp_replace(t, '[\p{{L}}\x20\x09-\x0D]+', '', 'g') AS rest, [lower(x) FOR x IN words] AS low,
         common, word_ref, char_ref
  FROM worded AS d LEFT JOIN covered USING (rid) LEFT JOIN reference USING (lang)
), measured AS (
  SELECT *, [len([1 FOR x IN low IF x = r]) FOR r IN common] AS used,
         length(rest) - length(regexp_replace(rest, '\p{{N}}+', '', 'g')) AS digits,
         length(rest) - length(regexp_replace(rest, {marks}, '', 'g')) AS marks
  FROM counted
), shared AS (
  SELECT *, n_words < {limits.min_words} OR n_repeat_words * 100 > n_words * {limits.max_repeat_percent} AS base_failed,
         [x / chars FOR x IN [word_chars - length(rest), digits, chars - word_chars, marks,
                              length(rest) - digits - marks]] AS p,
         list_concat([x / n_words FOR x IN used], [(n_words - list_sum(used)) / n_words]) AS q
  FROM measured
)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND (chars < {limits.guard_chars} OR char_ref IS NULL OR {_distance("p", "char_ref")} <= {limits.max_char_distance})
       AND (n_words < {limits.guard_words} OR word_ref IS NULL OR {_distance("q", "word_ref")} <= {limits.max_word_distance})
         AS kept
FROM shared
"""


def substring_dedup_sql(window: int = 35) -> str:
    return f"""
WITH {WORDS}, windows AS (
  SELECT rid, i, md5(array_to_string(words[i:i + {window - 1}], ' ')) AS w
  FROM worded, unnest(range(1, len(words) - {window - 2})) AS place(i)
), again AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1
), gone AS (
  SELECT DISTINCT rid, i + k AS i FROM again, unnest(range({window})) AS step(k)
), each_word AS (
  SELECT rid, i, words[i] AS word FROM worded, unnest(range(1, len(words) + 1)) AS place(i)
), kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each_word ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (rid)
"""


def fill_middle_sql(settings: fill_middle.Settings = fill_middle.Settings()) -> str:
    p, s, m = (_text(x) for x in (settings.prefix, settings.suffix, settings.middle))
    held = " OR ".join(f"contains(t, {x})" for x in (p, s, m))
    group = ", ".join(f"CAST('0x' || substr(digest, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    return rf"""
WITH said AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256({_text(settings.seed)} || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (SELECT *, CAST(len(units) AS BIGINT) AS n, {group} FROM said
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR {held} OR h3 % 100 >= {settings.rate} THEN 'plain'
              WHEN h4 % 100 < {settings.spm_rate} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parted AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS pre, coalesce(array_to_string(units[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suf
  FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {p} || pre || {s} || suf || {m} || mid
                        ELSE {s} || suf || {p} || pre || {m} || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parted
"""


#: SHA-1 in base 32: each five hex digits are four characters of five bits.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def warc_sql() -> str:
    return f"""
WITH paged AS (
  SELECT page_id, coalesce(html, '') AS payload, row_number() OVER () AS rid FROM pages
), ranked AS (
  SELECT *, sha1(payload) AS hex, row_number() OVER w AS place, first_value(page_id) OVER w AS largest
  FROM paged WINDOW w AS (PARTITION BY payload ORDER BY page_id DESC NULLS LAST, rid)
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('{BASE32}', 1 + ((CAST('0x' || substr(hex, CAST(
         5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), lambda a, b: a || b) AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN largest END AS refers_to
FROM ranked
"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lexical_search_sql(k: int = 20) -> str:
    def terms(of):
        return (f"regexp_extract_all(translate(coalesce({of}.text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                f"'abcdefghijklmnopqrstuvwxyz'), '{TERM}')")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS did, doc_id, {terms("d")} AS terms FROM documents AS d
), asked AS (
  SELECT row_number() OVER () AS iid, item_id, {terms("i")} AS terms FROM benchmark AS i
), corpus AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), held AS (
  SELECT did, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT did, unnest(terms) AS term FROM docs) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, n_docs
), lengths AS (
  SELECT did, doc_id, 100 - 25 + (25 * CAST(len(terms) AS BIGINT) * n_docs) // n_terms AS m FROM docs, corpus
), wanted AS (
  SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(terms) AS term FROM asked) GROUP BY ALL
), scored AS (
  SELECT iid, item_id, doc_id, did, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weighed USING (term) JOIN lengths USING (did) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, did) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {k}
"""
