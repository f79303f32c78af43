"""SQL for the operators that SQL can express, written from the contracts.

The SQL compares everything with everything and is for small tables.
"""

from __future__ import annotations

from cardloom.llm.quality_rules import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str, size: int) -> str:
    """(key, p, g): the windows of ``size`` words with their place, from 0."""
    joined = " || ' ' || ".join(f"ws[i + {k}]" for k in range(size))
    return f"""SELECT {key}, unnest(range(0, len(ws) - {size - 1})) AS p, unnest(list_transform(range(1, len(ws) - {size - 2}), lambda i: {joined})) AS g
        FROM (SELECT {key}, {_WORDS.format(_LOWER)} AS ws FROM {table}) WHERE len(ws) >= {size}"""


OP1 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("text")} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS ({_shingles("documents", "doc_id", 3).replace(_LOWER, "text")}),
twice AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
  len(list_filter(ws, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS n_bullet, len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS n_ellipsis FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= n_words AND 50 * n_stop >= n_words AND 10 * n_dup_lines <= 3 * n_lines AND 10 * n_bullet <= 9 * n_lines AND 10 * n_ellipsis <= 3 * n_lines AS kept FROM b"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), s AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, n AS payload_bytes, CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN head <> page_id THEN head END AS refers_to,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, 5 * (i // 4) + 1, 5))::INTEGER >> (5 * (3 - i % 4))::INTEGER) & 31) + 1), 1)), 'string_agg', '') AS payload_digest FROM s"""

OP4 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM ({_shingles("documents", "doc_id", 3)}) UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

OP6 = f"""
WITH d AS ({_shingles("documents", "doc_id", 5).replace(_LOWER, "lower(text)")}), i AS ({_shingles("benchmark", "item_id", 5).replace(_LOWER, "lower(text)")}),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id), c AS (SELECT item_id, g, count(*) AS k FROM i GROUP BY ALL),
met AS (SELECT doc_id, item_id, any_value(n) AS n, count(*) AS k FROM d JOIN c USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n)),
starts AS (SELECT doc_id, item_id, n, unnest(range(-(n // 5), last + n // 5 - n + 2)) AS start FROM met JOIN (SELECT doc_id, max(p) AS last FROM d GROUP BY doc_id) USING (doc_id)),
counted AS (SELECT doc_id, item_id, start, n, g, count(*) AS k FROM starts JOIN d USING (doc_id) WHERE d.p BETWEEN start AND start + n - 1 GROUP BY ALL),
summed AS (SELECT doc_id, item_id, start, n, sum(w.k)::BIGINT AS size, sum(least(w.k, coalesce(c.k, 0)))::BIGINT AS shared FROM counted w LEFT JOIN c USING (item_id, g) GROUP BY ALL)
SELECT doc_id, item_id, greatest(start, 0) AS start, shared, size + n - shared AS total FROM summed WHERE 100 * shared >= 80 * (size + n - shared)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared / (size + n - shared) DESC, start) = 1"""
