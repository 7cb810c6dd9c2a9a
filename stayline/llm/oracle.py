"""Check SQL of the queries that SQL can express, in the checking engine's dialect.

Written from the contracts: every string, window and pair is compared plainly.
"""

from __future__ import annotations

REPEATED_BYTES = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
         encode(coalesce(text, '')) AS b FROM documents),
s AS (
  SELECT rid, o, i, array_slice(b, i + 1, i + 50) AS piece
  FROM (SELECT rid, o, b, unnest(range(0, octet_length(b) - 49)) AS i FROM d)),
f AS (SELECT piece, min(o) AS first FROM s GROUP BY piece),
h AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before
      FROM s JOIN f ON s.piece = f.piece WHERE first < o),
r AS (SELECT rid, i, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END)
        OVER (PARTITION BY rid ORDER BY i) AS run FROM h),
spans AS (SELECT rid, min(i) AS a, max(i) + 50 AS e FROM r GROUP BY rid, run),
gaps AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY a), 0) AS g FROM spans),
cut AS (
  SELECT rid, count(*) AS n_spans, sum(e - a) AS n_removed, max(e) AS last,
         string_agg(hex(array_slice(b, g + 1, a)), '' ORDER BY a) AS kept
  FROM gaps JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || hex(array_slice(b, coalesce(last, 0) + 1, octet_length(b)))))
         AS kept_sha256
FROM d LEFT JOIN cut USING (rid)"""

RANKED = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
m AS (SELECT rid, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) AS m FROM d, size WHERE len(w) > 0),
post AS (SELECT rid, doc_id, t, count(*) AS tf FROM (SELECT rid, doc_id, unnest(w) AS t FROM d) GROUP BY ALL),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
       FROM (SELECT t, count(*) AS df FROM post GROUP BY t), size),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
s AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN wt USING (t) JOIN post USING (t) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50"""


PREFIXES = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
                       sha256(length(role) || ':' || role || text)) AS own
  FROM t GROUP BY conv_id),
c AS (
  SELECT a.conv_id, a.own, b.own AS head, xor(list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(a.conv_id::VARCHAR) + 1),
                       lambda i: CAST(ascii((a.conv_id::VARCHAR)[i]) AS BIGINT))),
           lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
         4294967295) % 4 AS h
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
r AS (SELECT conv_id, list_concat(coalesce(head[1:h], []), own[h + 1:]) AS turns FROM c),
p AS (SELECT conv_id, len(turns) AS size, d, turns[1:d] AS p
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM p GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE
           len(regexp_extract_all(p[d].text, '[^\\x20\\x09-\\x0D]+')) END AS own_saved
  FROM n LEFT JOIN k ON k.up = n.p),
below AS (
  SELECT a.p, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.own_saved) AS saved_tokens
  FROM m a JOIN (SELECT *, unnest(range(0, d + 1)) AS cut FROM m) b ON b.p[1:b.cut] = a.p GROUP BY a.p)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN below USING (p) LEFT JOIN m u ON m.d > 0 AND u.p = m.p[1:m.d - 1]"""


# The rules of op4: what is compared and the cutoffs on trial; a cutoff may reject 1 % of the good
# texts of a language and length band, with an error of 5 % over all trials.
RULES = {
    "symbols": ("n_symbols", "word_chars", "[0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3]"),
    "repeated_lines": ("n_dup_lines", "n_lines", "[0.05, 0.1, 0.2, 0.3, 0.4, 0.5]"),
    "repeated_words": ("n_repeat_words", "n_words", "[0.02, 0.05, 0.1, 0.15, 0.2, 0.25]"),
    "long_words": ("word_chars", "n_words", "[6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0]"),
}


def _rule_verdicts() -> str:
    grid = " UNION ALL ".join(
        f"SELECT '{r}' AS rule, unnest({cuts}::DOUBLE[]) AS cut" for r, (_, _, cuts) in RULES.items()
    )
    values = " UNION ALL ".join(
        f"SELECT rid, doc_id, in_lang, no_lang, band, '{r}' AS rule, "
        f"CASE WHEN {of} > 0 THEN {part} / {of} ELSE 0 END AS value FROM m WHERE NOT base_failed"
        for r, (part, of, _) in RULES.items()
    )
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                     lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS v
        FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM t)),
again AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM win
          SEMI JOIN (SELECT rid, v FROM win GROUP BY rid, v HAVING count(*) > 1) x
            ON win.rid = x.rid AND win.v = x.v),
rep AS (SELECT rid, sum(least(8, coalesce(next - i, 8))) AS n FROM again GROUP BY rid),
c AS (
  SELECT t.rid, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN rep ON rep.rid = t.rid),
m AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         coalesce(lang, '') AS in_lang, lang IS NULL AS no_lang,
         CASE WHEN n_words >= 1000 THEN 2 WHEN n_words >= 100 THEN 1 ELSE 0 END AS band FROM c),
v AS ({values}),
known AS (SELECT doc_id, min(quality) AS quality FROM labels
          WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
pick AS (
  SELECT rid FROM m WHERE NOT base_failed QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY n_dup_lines, n_lines, n_repeat_words, n_symbols, n_words,
    word_chars, lang NULLS FIRST) = 1),
one AS (SELECT v.*, quality FROM v SEMI JOIN pick ON v.rid = pick.rid JOIN known ON v.doc_id = known.doc_id),
tests AS (
  SELECT in_lang, no_lang, band, rule, cut, count(*) FILTER (quality = 1) AS n,
         count(*) FILTER (quality = 1 AND value > cut) AS k,
         count(*) FILTER (quality <> 1 AND value > cut) AS caught
  FROM one JOIN ({grid}) g USING (rule) GROUP BY ALL),
strata AS (SELECT count(*) AS s FROM (SELECT DISTINCT in_lang, no_lang, band FROM tests)),
tails AS (
  SELECT in_lang, no_lang, band, rule, cut, caught,
         sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))
           AS tail
  FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM tests WHERE n > 0 AND k <= 0.01 * n) GROUP BY ALL),
cuts AS (
  SELECT in_lang, no_lang, band, rule, max_by(cut, (caught, cut)) AS cut
  FROM tails, strata WHERE tail <= 0.05 / (s * (SELECT count(*) FROM ({grid}) g)) GROUP BY ALL),
broken AS (SELECT DISTINCT rid FROM v JOIN cuts USING (in_lang, no_lang, band, rule) WHERE value > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM broken) AS kept FROM m"""


# The kinds of op1: role, pattern (quotes doubled) and what its match must fulfil. The first three
# are fixed values of the contract; a match has the length it names.
SECRETS = {
    "assign": ("secret", """((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
               "length(g) >= 6"),
    "access": ("id", "AKIA[A-Z0-9]+", "length(f) >= 20"),
    "hex": ("secret", "[0-9a-f]+", "length(f) >= 24"),
    "account": ("id", """(?i:user(?:name)?|login|client_id|access_key_id|account)["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9@._-]{3,}""",
                "true"),
    "opaque": ("secret", "[A-Za-z0-9+/]{32,}={0,2}",
               "regexp_matches(f, '[0-9]') AND regexp_matches(f, '[a-z]') AND regexp_matches(f, '[A-Z]')"),
    "endpoint": ("endpoint", """(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\\x20\\x09-\\x0D"''<>]+""",
                 "true"),
}


def _secrets() -> str:
    strong = 3
    parts = []
    for number, (name, (role, pattern, check)) in enumerate(SECRETS.items()):
        value = f"regexp_extract(f, '{pattern}', 2)" if name == "assign" else "f"
        parts.append(f"""
  SELECT rid, {number} AS kind, '{name}' AS name, '{role}' AS role, e - length(f) AS a, e
  FROM (SELECT rid, f, {value} AS g, sum(length(p) + length(f)) OVER (PARTITION BY rid ORDER BY i) AS e
        FROM (SELECT rid, unnest(regexp_extract_all(text, '{pattern}')) AS f,
                     unnest(string_split_regex(text, '{pattern}')[:len(regexp_extract_all(text, '{pattern}'))]) AS p,
                     generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS i FROM t))
  WHERE {check}""")
    complete = ("w.role = 'secret' AND o.role IN ('id', 'endpoint') OR "
                "w.role IN ('id', 'endpoint') AND o.role = 'secret'")
    names = list(SECRETS)[:strong]
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(names))
    named = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in names)
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({' UNION ALL '.join(parts)}),
linked AS (
  SELECT * FROM parts w WHERE kind >= {strong}
  AND EXISTS (SELECT 1 FROM parts o WHERE o.rid = w.rid AND greatest(o.a, w.a) - least(o.e, w.e) <= 200
              AND ({complete}))
  AND NOT EXISTS (SELECT 1 FROM parts o WHERE o.rid = w.rid AND o.kind < {strong} AND o.a <= w.a
                  AND o.e >= w.e)),
spans AS (SELECT * FROM parts WHERE kind < {strong} UNION ALL SELECT * FROM linked),
listed AS (
  SELECT rid, {counts},
         string_agg(concat_ws(':', name, CAST(a AS BIGINT), CAST(e AS BIGINT)), ',' ORDER BY a, kind)
           FILTER (kind < {strong}) AS base,
         string_agg(concat_ws(':', name, CAST(a AS BIGINT), CAST(e AS BIGINT)), ',' ORDER BY a, kind) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, {named}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN listed USING (rid)"""


ORACLE = {
    "op1_secret_scan": _secrets(),
    "op4_quality_rules": _rule_verdicts(),
    "op6_suffix_dedup": REPEATED_BYTES,
    "op11_ranked_search": RANKED,
    "op12_prefix_trie": PREFIXES,
}
