"""Registered queries of the operators 11 to 13: thin digests, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import pages, repair, spelling
from .common import table
from .registry import query

#: crc32 of the bytes 0 to 255
CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS t(i)))"""


def crc_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of a DuckDB expression; needs crc_table among the tables read."""
    byte = f"lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2) AS BIGINT)"
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(range(strlen({text})), {byte})), "
            f"lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295)")


SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
         FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS n, concat(doc_id, ':', run) AS key FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {crc_sql('key')} AS h FROM per_doc, crc_table),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
                           ELSE run END AS word FROM hashed)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, substr(word, 1, CAST(i AS INT) - 1) || substr(word, CAST(i AS INT) + 1) AS rest
         FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
longer AS (SELECT DISTINCT l.word AS long, l.n AS long_n, w.word AS short, w.n AS short_n FROM less l JOIN words w ON w.word = l.rest),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION ALL SELECT long, short, short_n FROM longer UNION ALL SELECT short, long, long_n FROM longer),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS other_n FROM near GROUP BY word),
named AS (SELECT b.word, b.n_near, b.other_n, min(r.other) AS other FROM best b JOIN near r ON r.word = b.word AND r.other_n = b.other_n GROUP BY ALL),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
                 CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
          FROM words w LEFT JOIN named b ON b.word = w.word),
walk AS (SELECT word, word AS at, form AS nxt FROM forms
         UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON f.word = k.nxt)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk k ON k.word = f.word AND k.nxt IS NULL
"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


REPAIR_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
dealt AS (SELECT * REPLACE (key || '' AS key), {crc_sql('key')} % 20 AS deal FROM src, crc_table),
hurt AS (SELECT conv_id, turn, CASE WHEN deal = 4 THEN 'user' ELSE role END AS role,
                CASE deal WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(range(0, CASE deal WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again FROM dealt),
placed AS (SELECT *, coalesce('=' || conv_id, '') AS conv, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]') AS signs,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i FROM hurt),
faults AS (SELECT *, CASE WHEN len(signs) = 0 THEN 'blank'
                          WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                          WHEN signs[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY i) AS prev,
                  lead(i) OVER (PARTITION BY conv ORDER BY i) IS NULL AS final FROM placed),
counted AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (prev IS NOT NULL AND prev || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv),
-- states: 0 nothing, 1 system, 2 user, 3 assistant put out last; k empty turns go in first
ins(q, k, q1) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 2)),
told AS (SELECT q, k, q1, CASE WHEN k > 0 AND q = 2 THEN 'assistant:' WHEN k > 0 THEN 'user:' END AS first_in,
                CASE WHEN k > 1 THEN 'assistant:' END AS second_in FROM ins),
letters(letter) AS (VALUES ('K'), ('R'), ('D')),
edits AS (SELECT f.conv, f.i, t.q, t.k, l.letter,
                 CASE l.letter WHEN 'D' THEN t.q1 WHEN 'R' THEN CASE t.q1 WHEN 2 THEN 3 ELSE 2 END
                      ELSE CASE substr(role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS q2,
                 5 * t.k + CASE l.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                     + CASE WHEN l.letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
                 repeat('I', t.k) || l.letter AS audit,
                 list_filter([t.first_in, t.second_in, CASE l.letter WHEN 'K' THEN f.role || ':' || f.text
                     WHEN 'R' THEN CASE t.q1 WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text END], lambda x: x IS NOT NULL) AS lines
          FROM faults f, told t, letters l
          WHERE l.letter = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (l.letter = 'R'
                OR (substr(role, 1, 1) = 's' AND t.q1 = 0) OR (substr(role, 1, 1) = 'u' AND t.q1 <> 2) OR (substr(role, 1, 1) = 'a' AND t.q1 = 2)))),
walk AS (SELECT conv, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM counted
         UNION ALL
         SELECT conv, i, q, b.cost, b.audit, b.lines FROM (
             SELECT e.conv, e.i, e.q2 AS q, min({{'cost': CAST(w.cost + e.cost AS BIGINT), 'audit': w.audit || e.audit, 'lines': list_concat(w.lines, e.lines)}}) AS b
             FROM walk w JOIN edits e ON e.conv = w.conv AND e.i = w.i + 1 AND e.q = w.q GROUP BY e.conv, e.i, e.q2)),
ends AS (SELECT w.conv, min({{'cost': w.cost + CASE q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
                              'audit': w.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                              'lines': list_concat(w.lines, CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END)}}) AS b
         FROM walk w JOIN faults f ON f.conv = w.conv AND f.i = w.i AND f.final GROUP BY w.conv)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.b.cost, 0) AS cost, coalesce(e.b.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations) c
LEFT JOIN counted n ON n.conv = c.conv LEFT JOIN ends e ON e.conv = c.conv
"""


@query("op12_hirschberg_repair", REPAIR_SQL)
def op12_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair_report(rows, repair.damaged(rows))


@query("op11_wrapper_induction")
def op11_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")
