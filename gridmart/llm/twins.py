"""SQL for the rows of queries that need a checksum: crc32 is folded over the bytes by a table of 256 entries."""

_TABLE = """tab AS (
    SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY n) AS t
    FROM (SELECT unnest(range(256)) AS n)
)"""


def _crc(bytes_: str) -> str:
    """crc32 of a list of bytes, next to ``tab``."""
    step = "xor(a >> 8, t[CAST(xor(a, b) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda a, b: {step}), 4294967295)"


# Letters up to U+00FF have one or two bytes of UTF-8.
_BYTES = """flatten(list_transform(string_split(k, ''), lambda x:
    CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(ord(x) - 64 AS BIGINT)] END))"""

_ASCII = "list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT))"

SPELLING = rf"""
WITH RECURSIVE {_TABLE}, runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
), own AS (
    SELECT doc_id, run, count(*) AS n, concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run) AS k
    FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {_crc(_BYTES)} AS h FROM own, tab
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                                               || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
    SELECT word, n, substr(word, 1, p) AS head, substr(word, p + 2) AS tail
    FROM (SELECT *, unnest(range(length(word))) AS p FROM words)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n
    FROM places a JOIN places b ON a.head = b.head AND a.tail = b.tail AND length(a.word) = length(b.word) AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM places a JOIN words b ON a.head || a.tail = b.word
    UNION SELECT b.word, a.word, a.n FROM places a JOIN words b ON a.head || a.tail = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS near_n, arg_min(near, (-near_n, near)) AS near FROM pairs GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), way AS (
    SELECT word, word AS at FROM forms
    UNION ALL SELECT way.word, form FROM way JOIN forms ON way.at = forms.word WHERE form IS NOT NULL
)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN way ON way.word = f.word JOIN forms e ON e.word = way.at AND e.form IS NULL
"""

REPAIR = rf"""
WITH RECURSIVE {_TABLE}, m AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k
    FROM conversations
), c AS (
    SELECT conv_id, turn, role, text,
           {_crc(_ASCII)} % 20 AS kind
    FROM m, tab
), h AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM c
), r AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
           rtrim(text, E' \t\n\x0b\x0c\r') AS shown
    FROM h
), f AS (
    SELECT *, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
           CASE WHEN shown = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
    FROM r
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id
), moves AS (
    SELECT * FROM (VALUES (1, 1, '', 'D', 3), (2, 2, '', 'D', 3), (3, 3, '', 'D', 3), (0, 0, '', 'D', 3),
        (0, 2, '', 'R', 2), (1, 2, '', 'R', 2), (2, 3, '', 'R', 2), (3, 2, '', 'R', 2),
        (0, 1, 's', 'K', 0), (0, 2, 'u', 'K', 0), (1, 2, 'u', 'K', 0), (2, 3, 'a', 'K', 0), (3, 2, 'u', 'K', 0))
        AS t(s, e, need, letter, price)
), added AS (
    SELECT * FROM (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 2, 'I'), (1, 3, 'II'),
        (2, 3, 'I'), (3, 2, 'I')) AS t(s, e, letters)
), best AS (
    SELECT counts.conv_id, CAST(0 AS BIGINT) AS i, a.e AS s, lpad(CAST(2 * length(letters) AS VARCHAR), 18, '0') || letters AS label
    FROM counts, added a WHERE a.s = 0
    UNION ALL
    SELECT best.conv_id, best.i + 1, a.e,
           min(lpad(CAST(CAST(left(label, 18) AS BIGINT) + price + 2 * length(letters)
                         + CASE WHEN fault = 't' AND letter <> 'D' THEN 1 ELSE 0 END AS VARCHAR), 18, '0')
               || substr(label, 19) || letter || letters)
    FROM best JOIN f ON f.conv_id IS NOT DISTINCT FROM best.conv_id AND f.i = best.i + 1
    JOIN moves v ON v.s = best.s AND (v.need = '' OR v.need = f.ini) AND (letter = 'D' OR fault NOT IN ('b', 'd'))
    JOIN added a ON a.s = v.e
    GROUP BY ALL
), chosen AS (
    SELECT best.conv_id, min(label) AS label FROM best JOIN counts ON best.conv_id IS NOT DISTINCT FROM counts.conv_id AND i = n
    WHERE s IN (0, 3) GROUP BY ALL
), letters AS (
    SELECT conv_id, audit, pos, audit[pos] AS letter,
           length(replace(audit[1:pos], 'I', '')) AS i,
           length(replace(audit[1:pos], 'D', '')) AS out
    FROM (SELECT conv_id, substr(label, 19) AS audit, unnest(range(1, length(label) - 17)) AS pos FROM chosen)
), placed AS (
    SELECT l.*, f.role, f.text, bool_or(letter = 'K' AND ini = 's') OVER (PARTITION BY l.conv_id) AS opened
    FROM letters l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND letter <> 'I'
    WHERE letter <> 'D'
), repaired AS (
    SELECT conv_id, sha256(string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (out - CASE WHEN opened THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY out)) AS sha
    FROM placed GROUP BY conv_id
), ids AS (
    SELECT DISTINCT conv_id FROM conversations
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(left(label, 18) AS BIGINT), 0) AS cost, coalesce(substr(label, 19), '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN counts ON ids.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN chosen ON ids.conv_id IS NOT DISTINCT FROM chosen.conv_id
LEFT JOIN repaired ON ids.conv_id IS NOT DISTINCT FROM repaired.conv_id
"""
