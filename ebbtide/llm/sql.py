"""The queries of this package as SQL for an independent engine."""

from __future__ import annotations

from ebbtide.llm import licenses, secret_scan


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WARC = """
WITH hashed AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), numbered AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex) AS winner,
           row_number() OVER (PARTITION BY hex, page_id) AS copy,
           list_transform(range(4), lambda i: ('0x' || substr(hex, 10 * i + 1, 10))::BIGINT) AS parts
    FROM hashed
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda j:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((parts[(j // 8) + 1] >> (35 - 5 * (j % 8))::INT) & 31) + 1)::INT, 1)
       ), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM winner AND copy = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM winner AND copy = 1 THEN NULL ELSE winner END AS refers_to
FROM numbered
"""


def _kind(kind: str, pattern: str, place: int) -> str:
    """Spans of one kind: what lies between the matches tells where they are."""
    value = {"assign": f"regexp_extract(m, {_quoted(pattern)}, 2)", "bare": "regexp_replace(m, '\\.+$', '')"}.get(kind, "m")
    least = f"WHERE length(value) >= {secret_scan.LEAST_ASSIGNED}" if kind in ("assign", "bare") else ""
    return f"""
    SELECT row, doc_id, source, '{kind}' AS kind, {place} AS place, stop - length(m) AS start,
           {'stop - length(m) + length(value)' if kind == 'bare' else 'stop'} AS stop, regexp_replace(value, '\\.+$', '') AS value FROM (
        SELECT *, {value} AS value,
               (sum(length(gap) + length(m)) OVER (PARTITION BY row ORDER BY nth))::BIGINT AS stop
        FROM (
            SELECT row, doc_id, source, unnest(found) AS m, unnest(gaps[1:len(found)]) AS gap,
                   unnest(range(len(found))) AS nth
            FROM (SELECT row, doc_id, source, regexp_extract_all(body, {_quoted(pattern)}) AS found,
                         string_split_regex(body, {_quoted(pattern)}) AS gaps FROM numbered)
            WHERE len(found) > 0
        )
    ) {least}"""


SECRETS = f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS body FROM documents),
spans AS ({' UNION ALL '.join(_kind(k, p, i) for i, (k, p) in enumerate(zip(secret_scan.KINDS, (secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX), strict=True)))}),
looked AS (
    SELECT value, count(DISTINCT source) AS owners, len(list_distinct(string_split(value, ''))) >= {secret_scan.LEAST_VARIED}
           AND 4 * len(list_distinct(string_split(value, ''))) >= least(length(value), {secret_scan.VARIED_LENGTH})
           AND NOT regexp_matches(value, {_quoted(secret_scan.PLACEHOLDER)}) AS plausible
    FROM spans GROUP BY value
), bare AS (
    SELECT b.* FROM ({_kind(secret_scan.BARE, secret_scan.TOKEN, 3)}) b
    JOIN looked l ON l.value = b.value AND owners < {secret_scan.WIDELY} AND plausible
), owned AS (
    SELECT value, count(DISTINCT source) AS owners FROM (SELECT value, source FROM spans UNION ALL SELECT value, source FROM bare) GROUP BY value
), every AS (
    SELECT * FROM spans UNION ALL
    SELECT b.* FROM bare b JOIN owned o ON o.value = b.value AND o.owners < {secret_scan.WIDELY}
    WHERE NOT EXISTS (FROM spans s WHERE s.row = b.row AND s.start <= b.start AND b.stop <= s.stop)
), labelled AS (
    SELECT s.*, CASE WHEN o.owners >= {secret_scan.WIDELY} THEN 'copied' WHEN plausible THEN 'live' ELSE 'placeholder' END AS label
    FROM every s JOIN owned o ON o.value = s.value JOIN looked l ON l.value = s.value
), listed AS (
    SELECT row, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (kind <> '{secret_scan.BARE}') AS base,
           {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_scan.KINDS)},
           {', '.join(f"count(*) FILTER (label = '{x}') AS n_{x}" for x in ('live', 'copied', 'placeholder'))}
    FROM labelled GROUP BY row
)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in secret_scan.KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       {', '.join(f'coalesce(n_{x}, 0) AS n_{x}' for x in ('live', 'copied', 'placeholder'))}
FROM numbered LEFT JOIN listed USING (row)
"""

_TEMPLATES = ", ".join(f"({i}, {_quoted(n)}, {_quoted(t)})" for i, (n, t) in enumerate(licenses.TEMPLATES))
LICENSES = f"""
WITH numbered AS (
    SELECT row_number() OVER () AS row, doc_id, '/' || source || '/' || lang AS directory, coalesce(text, '') AS body FROM documents
), units AS (
    SELECT DISTINCT row, trim(unit, ' ') AS unit FROM (
        SELECT row, unnest(list_concat(list_concat(string_split(body, chr(10)), string_split_regex(body, '\\n\\n+')), string_split_regex(body, {_quoted(licenses.SENTENCE)}))) AS unit FROM numbered
    ) WHERE regexp_matches(unit, {_quoted(licenses.ANCHORS)})
), words AS (
    SELECT row, unit, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS term FROM units
), terms AS (SELECT row, unit, term, count(*) AS tf FROM words GROUP BY ALL),
templates AS (SELECT * FROM (VALUES {_TEMPLATES}) AS t(template, license, statement)),
template_terms AS (
    SELECT template, license, term, count(*) AS tf FROM (
        SELECT template, license, unnest(regexp_extract_all(lower(statement), '[a-z0-9]+')) AS term FROM templates
    ) GROUP BY ALL
), idf AS (
    SELECT term, ln((1.0 + (SELECT count(*) FROM units) + {len(licenses.TEMPLATES)}) / (1 + count(*))) + 1 AS idf
    FROM (SELECT term FROM terms UNION ALL SELECT term FROM template_terms) GROUP BY term
), own AS (SELECT row, unit, term, tf * idf AS w FROM terms JOIN idf USING (term)),
theirs AS (SELECT template, license, term, tf * idf AS v FROM template_terms JOIN idf USING (term)),
norms AS (SELECT row, unit, sqrt(sum(w * w)) AS norm FROM own GROUP BY ALL),
sides AS (SELECT template, sqrt(sum(v * v)) AS side FROM theirs GROUP BY ALL),
cosines AS (
    SELECT row, unit, license, round(sum(w * v) / (any_value(norm) * any_value(side)), 9) AS cosine
    FROM own JOIN theirs USING (term) JOIN norms USING (row, unit) JOIN sides USING (template)
    GROUP BY row, unit, license, template
), best AS (
    SELECT row, license AS own_license, cosine, length(unit) AS size FROM cosines WHERE cosine >= {licenses.COSINE}
    QUALIFY row_number() OVER (PARTITION BY row ORDER BY cosine DESC, length(unit) DESC, license) = 1
), told AS (SELECT n.*, own_license, cosine, size FROM numbered n LEFT JOIN best USING (row)),
spoken AS (
    SELECT directory AS above, own_license AS inherited FROM told
    WHERE own_license IS NOT NULL AND directory IS NOT NULL AND doc_id IS NOT NULL AND 2 * size >= length(trim(body, ' '))
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, own_license) = 1
)
SELECT doc_id, own_license, round(cosine, 6) AS cosine, coalesce(own_license, inherited) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'own' ELSE above END AS origin
FROM told LEFT JOIN spoken ON told.directory = spoken.above
"""

JACCARD = """
WITH RECURSIVE numbered AS (
    SELECT row_number() OVER () AS row, doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT row, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
    FROM numbered
), sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
pairs AS (
    SELECT a.row AS a, b.row AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), reached(row, other) AS (
    SELECT row, row FROM numbered UNION SELECT r.row, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT n.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM numbered n JOIN reached r ON r.row = n.row JOIN numbered o ON o.row = r.other LEFT JOIN sizes s ON s.row = n.row
GROUP BY n.row, n.doc_id
"""

TRIE = """
WITH ordered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
               list_transform(range(8 * length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i // 8 + 1, 1)) >> (i % 8)::INT),
               lambda crc, bit: CASE WHEN xor(crc, bit) & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END,
               4294967295::BIGINT), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM ordered)
), rebuilt AS (
    SELECT c.conv_id, place, role, text FROM convs c JOIN ordered o ON o.conv_id = c.base AND place <= h
    UNION ALL SELECT c.conv_id, place, role, text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND place > h
), lists AS (
    SELECT c.conv_id, coalesce(any_value(turns), []) AS turns
    FROM convs c LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM rebuilt GROUP BY conv_id) r USING (conv_id)
    GROUP BY c.conv_id
), prefixes AS (
    SELECT conv_id, turns[1:depth] AS prefix, depth, depth = len(turns) AS ends
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM lists)
), nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN depth > 0 THEN prefix[1:depth - 1] END AS above,
           CASE WHEN depth > 0 THEN (count(*) - 1) * octet_length(encode(prefix[depth].text)) ELSE 0 END AS own,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY prefix, depth
), children AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix),
subtrees AS (
    SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
    FROM (SELECT prefix[1:unnest(range(depth + 1))] AS top, n_children, own FROM counted) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees ON top = n.prefix LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.above AND p.depth = n.depth - 1
"""

RULES = """
WITH numbered AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS body FROM documents
), parts AS (
    SELECT row, doc_id, source, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
           list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
           len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols
    FROM numbered
), windows AS (
    SELECT row, unnest(range(1, len(words) - 1)) AS place,
           unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) AS run
    FROM parts WHERE len(words) >= 3
), repeated AS (
    SELECT row, count(*) AS n FROM (
        SELECT DISTINCT row, place + unnest([0, 1, 2]) AS word
        FROM (SELECT row, place, count(*) OVER (PARTITION BY row, run) AS times FROM windows) WHERE times > 1
    ) GROUP BY row
), measured AS (
    SELECT p.row, doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
    FROM parts p LEFT JOIN repeated r USING (row)
), ruled AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 10 * n_symbols > n_words AS symbols,
           10 * n_dup_lines > 3 * n_lines AS lines, word_chars < 3 * n_words AS short_words,
           word_chars > 12 * n_words AS long_words
    FROM measured
), failures AS (
    UNPIVOT (SELECT row, source, base_failed, symbols, lines, short_words, long_words FROM ruled)
    ON base_failed, symbols, lines, short_words, long_words INTO NAME rule VALUE failed
), hosts AS (
    SELECT rule, source, count(*) AS n, sum(failed::INT) AS f FROM failures GROUP BY ALL
), means AS (SELECT rule, sum(f) / sum(n) AS mean, sum(n) AS total, count(*) AS hosts FROM hosts GROUP BY rule),
priors AS (
    SELECT rule, mean, least(greatest(mean * (1 - mean)
               / greatest((sum(n * (f / n - mean) ** 2) - any_value(hosts) * mean * (1 - mean)) / any_value(total), 1e-9) - 1, 1), 1e6) AS strength
    FROM hosts JOIN means USING (rule) GROUP BY rule, mean
), known AS (
    SELECT source, rule FROM hosts JOIN priors USING (rule)
    WHERE 100 * (f + mean * strength) / (n + strength) >= CASE rule WHEN 'base_failed' THEN 90 ELSE 30 END
), told AS (
    SELECT r.*, EXISTS (FROM known k WHERE k.source IS NOT DISTINCT FROM r.source AND rule = 'base_failed') AS host_rejected,
           (SELECT list(rule) FROM known k WHERE k.source IS NOT DISTINCT FROM r.source) AS bad
    FROM ruled r
), reasoned AS (
    SELECT *, CASE WHEN base_failed THEN 'base' WHEN host_rejected THEN 'host'
                   WHEN symbols AND list_contains(bad, 'symbols') THEN 'symbols' WHEN lines AND list_contains(bad, 'lines') THEN 'lines'
                   WHEN short_words AND list_contains(bad, 'short_words') THEN 'short_words'
                   WHEN long_words AND list_contains(bad, 'long_words') THEN 'long_words' END AS reason
    FROM told
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason IS NULL AS kept, host_rejected, reason
FROM reasoned
"""

SQL = {
    "op4_warc": WARC,
    "op6_secret_scan": SECRETS,
    "op8_license_scan": LICENSES,
    "op10_ngram_jaccard_join": JACCARD,
    "op12_conversation_prefix_trie": TRIE,
    "op13_quality_rules": RULES,
}
