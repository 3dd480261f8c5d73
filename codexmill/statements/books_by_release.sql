SELECT details.releaseStatus AS release, count(*) AS n, count(DISTINCT lower(trim(id))) AS books
FROM book_evidence
WHERE details.pageCount >= :least AND status = :status
GROUP BY details.releaseStatus
