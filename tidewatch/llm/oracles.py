"""SQL of the corpus queries, for DuckDB."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP10 = rf"""
WITH t AS (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
p AS (SELECT u, i, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT u, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
g AS (SELECT u, s, list(i) AS spots FROM p GROUP BY u, s HAVING count(*) > 1),
c AS (SELECT u, count(DISTINCT k) AS n_repeat_words FROM (SELECT u, unnest(range(i, i + 5)) AS k FROM (SELECT u, unnest(spots) AS i FROM g)) GROUP BY u),
m AS (
    SELECT t.u, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
        len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM t LEFT JOIN c ON c.u = t.u
),
b AS (SELECT *, len(l) - len(list_distinct(l)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (100 * n_symbols > 8 * word_chars OR 100 * n_dup_lines > 30 * len(l)
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_letter_words < 50 * n_words
        OR 100 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) > 30 * len(l)
        OR 100 * len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) > 90 * len(l)) AS kept
FROM b
"""

def shingles(width: int) -> str:
    """(doc_id, s): the distinct shingles of each text, the whole of it with fewer words; n: how many."""
    return rf"""
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + {width - 1}], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 2}, 2))) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
"""


def similar(width: int) -> str:
    """Documents linked by their shingles, and what each reaches."""
    return f"""
WITH RECURSIVE {shingles(width)},
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id"""


_REACHED = " FROM w JOIN least ON least.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"
OP8 = similar(5) + ", w.doc_id = component_id AS kept" + _REACHED
OP13 = similar(4) + _REACHED


_BODY = "('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10))"


def _records(name: str, rows: str) -> str:
    return f"""
{name}_raw AS (SELECT page_id, (page_id - (SELECT min(page_id) FROM pages)) // 256 AS file, strlen(body) AS length, sha256(body) AS sha FROM (SELECT page_id, {_BODY} AS body FROM ({rows}))),
{name} AS (
    SELECT *, row_number() OVER o - 1 AS ordinal, (sum(length) OVER o - length)::BIGINT AS start, row_number() OVER (PARTITION BY file, page_id ORDER BY sha) AS copy
    FROM {name}_raw WINDOW o AS (PARTITION BY file ORDER BY page_id, sha ROWS UNBOUNDED PRECEDING)
)"""


_DAMAGED = """
SELECT page_id, url, CASE WHEN page_id % 101 = 7 THEN substr(html, 1, 100) WHEN page_id % 103 = 11 THEN '#' || substr(html, 2) ELSE html END AS html
FROM pages WHERE page_id % 211 <> 13 UNION ALL SELECT page_id, url, html FROM pages WHERE page_id % 401 = 31
"""

OP5 = f"""
WITH {_records("p", "SELECT page_id, url, html FROM pages")}, {_records("q", _DAMAGED)},
px AS (SELECT p.* FROM p LEFT JOIN q ON p.file = q.file AND p.ordinal = q.ordinal AND p.sha = q.sha AND p.start = q.start WHERE q.file IS NULL),
qx AS (SELECT q.* FROM q LEFT JOIN p ON p.file = q.file AND p.ordinal = q.ordinal AND p.sha = q.sha AND p.start = q.start WHERE p.file IS NULL),
met AS (SELECT coalesce(px.file, qx.file) AS file, px.ordinal AS po, qx.ordinal AS qo, qx.page_id, qx.start, qx.length, qx.sha,
    CASE WHEN qx.sha IS NULL THEN 'missing' WHEN px.sha IS NULL THEN 'extra' WHEN px.sha = qx.sha THEN 'moved' ELSE 'corrupt' END AS status
    FROM px FULL JOIN qx ON px.file = qx.file AND px.page_id = qx.page_id AND px.copy = qx.copy)
SELECT p.page_id, p.file, p.ordinal, p.start, p.length, p.sha, coalesce(m.status, 'ok') AS status
FROM p LEFT JOIN met m ON m.file = p.file AND m.po = p.ordinal
UNION ALL SELECT page_id, file, qo, start, length, sha, status FROM met WHERE status = 'extra'
"""


def _notices(notices: dict[str, str]) -> str:
    quoted = lambda x: x.replace("'", "''")
    return ", ".join(f"('{quoted(k)}', '{quoted(v)}')" for k, v in sorted(notices.items()))


def op2(notices: dict[str, str]) -> str:
    """Every window of every text against every template, from the shingles that they share."""
    words = r"list_filter(list_transform(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda w: regexp_replace(w, '^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$', '', 'g')), lambda w: w <> '')"
    return f"""
WITH n(license, text) AS (VALUES {_notices(notices)}),
nw AS (SELECT license, {words} AS w FROM n),
ns AS (SELECT license, len(w) - 4 AS n, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM nw)),
nd AS (SELECT license, n, s, count(*) OVER (PARTITION BY license) AS own FROM (SELECT DISTINCT license, n, s FROM ns)),
d AS (SELECT row_number() OVER () AS u, doc_id, {words} AS w FROM documents),
ds AS (SELECT u, doc_id, i - 1 AS i, size, array_to_string(w, ' ') AS s FROM (SELECT u, doc_id, i, len(w) - 4 AS size, w[i : i + 4] AS w FROM (SELECT u, doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))),
hit AS (SELECT u, doc_id, size, license, n, own, i, ds.s FROM ds JOIN nd ON nd.s = ds.s),
win AS (SELECT u, doc_id, license, own, n, size, s, unnest(range(greatest(i - n + 1, 0), i + 1)) AS a FROM hit),
per AS (SELECT u, doc_id, license, a, count(DISTINCT s) / own AS containment FROM win WHERE a + n <= size OR (a = 0 AND size < n) GROUP BY u, doc_id, license, own, a)
SELECT doc_id, license, max(containment) AS containment, arg_min(a, (-containment, a))::BIGINT AS first_word, count(*) AS n_windows
FROM per WHERE containment >= 0.8 GROUP BY u, doc_id, license
"""


def op12(least_docs: int, most_rank: int) -> str:
    """Every kept term priced in every group and language, groups met pair by pair."""
    price = "(1 + (1000000000::HUGEINT * (n + 5)) // (all_n + 5 * v))::BIGINT"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS u, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS (SELECT u, lang, source, unnest(w) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT u) >= {least_docs}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
gt AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
gn AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS all_n FROM gt JOIN v USING (lang)),
gp AS (SELECT lang, source, term, n, {price} AS p FROM gn),
ln AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS all_n FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)),
lp AS (SELECT lang, term, {price} AS q FROM ln),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM terms) WHERE rank <= {most_rank}
"""
