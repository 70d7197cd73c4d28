"""SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

from claimloom.llm import line_rules, warc
from claimloom.llm.chat import Template

_TEMPLATE = Template()
_MARKS = len(_TEMPLATE.opening) + len(_TEMPLATE.heading) + len(_TEMPLATE.closing)


def _escaped_length(column: str) -> str:
    """Each escape character and each first character of a control string becomes two."""
    return f"length({column}) + length({column}) - length(translate({column}, '\\<[', ''))"


CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), led AS (
    SELECT *, lag(role) OVER o AS before, lead(role) OVER o IS NULL AS at_end
    FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
           FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_MARKS} + {_escaped_length('role')} + {_escaped_length('text')}) AS BIGINT)
           AS formatted_chars,
       bool_and(CASE WHEN role = 'system' THEN before IS NULL
                     WHEN role = 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                     WHEN role = 'assistant' THEN coalesce(before = 'user', false)
                     ELSE false END
                AND (NOT at_end OR role = 'assistant')) AS in_order
FROM led GROUP BY conv_id
"""

# Eight groups of five hexadecimal digits are four base-32 digits each.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',"
    f" ((('0x' || substr(sha, {5 * group + 1}, 5))::BIGINT >> {shift}) & 31)::INTEGER + 1, 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH sums AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), firsts AS (
    SELECT *, CASE WHEN payload_bytes >= {warc.MIN_BYTES}
                   THEN min(page_id) OVER (PARTITION BY sha) END AS first_id
    FROM sums
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN first_id <> page_id OR (first_id IS NOT NULL AND page_id IS NULL)
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id OR (first_id IS NOT NULL AND page_id IS NULL)
            THEN first_id END AS refers_to
FROM firsts
"""

_WORD = "'[^\\x20\\x09-\\x0D]+'"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_RULES = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text
    FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, {_WORD}) AS w FROM docs
), places AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_zip(w[:-3], w[2:-2], w[3:])) AS window3
    FROM words WHERE len(w) >= 3
), repeated AS (
    SELECT r, i FROM places QUALIFY count(*) OVER (PARTITION BY r, window3) > 1
), marked AS (
    SELECT r, count(DISTINCT i + o) AS n_repeat_words
    FROM repeated, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r
), lines AS (
    SELECT r, host, line, regexp_extract_all({_LOWER.format('line')}, {_WORD}) AS w
    FROM (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM docs)
), texts AS (
    SELECT r, host, line, len(w) AS n, substr(md5(array_to_string(w, ' ')), 1, {line_rules.DIGITS}) AS key
    FROM lines WHERE len(w) > 0
), doubled AS (
    SELECT r, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines
    FROM (SELECT r, line, count(*) AS n FROM texts GROUP BY ALL) GROUP BY r
), keys AS (
    SELECT r, host, key, CAST(sum(n) AS BIGINT) AS n FROM texts GROUP BY ALL
), plain AS (
    SELECT r, md5(array_to_string(list_filter(list_transform(string_split({_LOWER.format('text')}, chr(10)),
               lambda line: array_to_string(regexp_extract_all(line, {_WORD}), ' ')), lambda line: line <> ''), chr(10)))
           AS lines_key
    FROM docs
), common AS (
    SELECT host, key FROM keys JOIN plain USING (r)
    GROUP BY host, key HAVING count(DISTINCT lines_key) > {line_rules.LINE_DOCS}
), lost AS (
    SELECT r, CAST(sum(n) AS BIGINT) AS removed_words FROM keys SEMI JOIN common USING (host, key) GROUP BY r
), counted AS (
    SELECT doc_id, len(w) AS n_words,
           CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(removed_words, 0) AS removed_words
    FROM words LEFT JOIN doubled USING (r) LEFT JOIN marked USING (r) LEFT JOIN lost USING (r)
)
SELECT *, n_words < {line_rules.MIN_WORDS} OR n_repeat_words * 100 > n_words * {line_rules.REPEATED_PERCENT}
           AS base_failed,
       NOT base_failed AND (n_words - removed_words) * 100 >= n_words * {line_rules.KEPT_PERCENT} AS kept
FROM counted
"""

PROJECTIONS = """
WITH RECURSIVE units AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
JOIN (SELECT vec_id, count(b) AS n_links FROM embeddings LEFT JOIN links ON a = vec_id GROUP BY vec_id)
USING (vec_id)
"""

# CRC-32 of a text of digits: eight steps for each byte, low bits first.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: ord(ch)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                               lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))))"""

TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, conv_id - conv_id % 100 AS first, {_CRC32.format('conv_id')} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT ids.conv_id, n, role, text FROM ids JOIN turns ON turns.conv_id = first AND n <= h
    UNION ALL
    SELECT ids.conv_id, n + 6, role, text FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND n > h
), prefixes AS (
    SELECT conv_id, row_number() OVER o AS depth, length(text) AS chars,
           sha256(string_agg(concat_ws(':', length(role), role, length(text), text), ';') OVER o) AS node
    FROM rebuilt WINDOW o AS (PARTITION BY conv_id ORDER BY n)
    UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), led AS (
    SELECT *, lag(node) OVER o AS parent, lead(node) OVER o IS NULL AS ends
    FROM prefixes WINDOW o AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(chars) AS chars, bool_and(ends) AS leaf,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ended
    FROM led GROUP BY node, depth
), sums AS (
    SELECT p.node, count(*) FILTER (n.leaf) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node
), born AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(nodes.ended, '')) AS ends_sha256
FROM nodes JOIN sums USING (node) LEFT JOIN born USING (node)
LEFT JOIN nodes above ON above.node = nodes.parent
"""

# The pages of the table mark their article, and hold these character references.
HTML_TEXT = """
WITH blocks AS (
    SELECT page_id, url, unnest(regexp_split_to_array(
               regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h[1-6])>')) AS block
    FROM pages
), texts AS (
    SELECT page_id, url, list_filter(list(trim(regexp_replace(
               regexp_replace(regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
                              '&quot;?', '"', 'g').regexp_replace('&amp;?', '&', 'g'),
               '[ \\t\\n\\r\\f]+', ' ', 'g'))), lambda t: t <> '') AS parts
    FROM blocks GROUP BY page_id, url
)
SELECT page_id, url, array_to_string(parts, chr(10) || chr(10)) AS text, length(text) AS n_chars FROM texts
"""

ORACLE = {
    "op6_line_rules": LINE_RULES,
    "op8_chat": CHAT,
    "op9_warc": WARC,
    "op10_projections": PROJECTIONS,
    "op12_prefix_trie": TRIE,
    "op13_html_text": HTML_TEXT,
}
