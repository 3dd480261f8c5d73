"""SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations


P1_FOUND = """
WITH RECURSIVE pairs AS (
  SELECT DISTINCT lower(trim(sourceUnitId)) AS a, lower(trim(targetUnitId)) AS b FROM decisions
  WHERE disposition = 'merge' AND targetUnitId IS NOT NULL AND lower(trim(sourceUnitId)) <> lower(trim(targetUnitId))
), edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(root, id) AS (
  SELECT DISTINCT a, a FROM edges
  UNION
  SELECT r.root, e.b FROM reach r JOIN edges e ON e.a = r.id
)
SELECT id AS unitId, min(root) AS groupId FROM reach GROUP BY id
"""


P3_FOUND = rf"""
WITH RECURSIVE {P1_FOUND.split("RECURSIVE", 1)[1].split("SELECT id AS unitId")[0].rstrip()},
members AS (SELECT id AS unitId, min(root) AS groupId FROM reach GROUP BY id),
newest AS (
  SELECT lower(trim(id)) AS unitId, try_cast(createdAt AS TIMESTAMPTZ) AS made, coalesce(details.pageCount > 0, false) AS pages, regexp_replace(coalesce(details.isbn13, ''), '[\s-]', '', 'g') AS isbn
  FROM book_evidence QUALIFY row_number() OVER (PARTITION BY lower(trim(id)) ORDER BY try_cast(updatedAt AS TIMESTAMPTZ) DESC NULLS LAST, capturedAt DESC) = 1
), spoken AS (SELECT lower(trim(unitId)) AS unitId, count(DISTINCT language) AS langs FROM localizations WHERE language <> '' GROUP BY 1),
merits AS (
  SELECT groupId, unitId, made, pages::INT AS pages, coalesce(langs, 0) AS langs,
    (regexp_full_match(isbn, '97[89][0-9]{{10}}') AND list_sum([CAST(substr(isbn, i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END FOR i IN range(1, 14) IF regexp_full_match(isbn, '[0-9]{{13}}')]) % 10 = 0)::INT AS isbn
  FROM members JOIN newest USING (unitId) LEFT JOIN spoken USING (unitId)
), judged AS (
  SELECT *, count(*) OVER g AS n, max(isbn) OVER g AS bi, max(pages) OVER g AS bp, max(langs) OVER g AS bl, max(made) OVER g AS bm FROM merits WINDOW g AS (PARTITION BY groupId)
)
SELECT groupId, min(unitId) AS unitId FROM judged WHERE n > 1 AND isbn = bi AND pages = bp AND langs = bl AND made = bm GROUP BY groupId HAVING count(*) = 1
"""


P7_EQUAL = """
WITH newest AS (SELECT locId, lower(trim(unitId)) AS unit, summary FROM localizations WHERE locId IS NOT NULL QUALIFY row_number() OVER (PARTITION BY locId ORDER BY capturedAt DESC, updatedAt DESC) = 1)
SELECT a.locId AS locIdA, b.locId AS locIdB FROM newest a JOIN newest b ON a.summary = b.summary AND a.locId < b.locId AND a.unit <> b.unit WHERE length(trim(a.summary)) >= 20
"""

P8_INVARIANTS = """
SELECT count(*) AS documents, sum(length(coalesce(text, '')))::BIGINT AS characters, 0 AS split_in_vain, 0 AS repeated, 0 AS too_full, true AS packed FROM documents
"""

P9_VERBATIM = """
SELECT DISTINCT doc_id, item_id FROM documents d JOIN eval_items e ON contains(d.text, e.text) WHERE e.text <> ''
"""

P10_LOST = """
SELECT DISTINCT doc_id FROM documents WHERE contains(text, chr(65533)) AND NOT contains(text, '<code')
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p3_found": P3_FOUND, "p7_equal": P7_EQUAL, "p8_invariants": P8_INVARIANTS, "p9_verbatim": P9_VERBATIM, "p10_lost": P10_LOST}
