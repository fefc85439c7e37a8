"""DuckDB counterparts of the ``pN_`` queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "p2_found": """
        SELECT section_id, CAST(regexp_matches(content, '[^\\s.!?。！？।؟]{1000}[^\\s.!?。！？।؟]{1000}[^\\s.!?。！？।؟]{501}') AS INT) AS hard_cut
        FROM sections WHERE length(content) > 2500
    """,
    "p6_found": """
        WITH RECURSIVE p AS (
          SELECT paper_id, CASE lower(trim(source)) WHEN 'pubmed' THEN 0 WHEN 'europepmc' THEN 1 WHEN 'semantic_scholar' THEN 2 WHEN 'openalex' THEN 3 WHEN 'crossref' THEN 4 WHEN 'core' THEN 5 ELSE 6 END AS src,
            coalesce(-epoch_us(try_cast(CASE WHEN regexp_matches(trim(fetched_at), '(Z|[+-][0-9]{2}:?[0-9]{2})$') THEN trim(fetched_at) ELSE trim(fetched_at) || 'Z' END AS TIMESTAMPTZ)), 4611686018427387904) AS age,
            nullif(regexp_extract(lower(trim(doi)), '(10\\.[0-9]{3,9}/[^\\s]+?)[.,;]?$', 1), '') AS d, nullif(regexp_extract(trim(pmid), '^0*([1-9][0-9]*)$', 1), '') AS m, nullif(lower(trim(content_hash)), '') AS h FROM papers),
        k AS (SELECT paper_id, 'd' || d AS key FROM p WHERE d IS NOT NULL UNION ALL SELECT paper_id, 'p' || m FROM p WHERE m IS NOT NULL UNION ALL SELECT paper_id, 'h' || h FROM p WHERE h IS NOT NULL),
        e AS (SELECT DISTINCT a.paper_id AS x, b.paper_id AS y FROM k a JOIN k b USING (key)),
        r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
        SELECT r.x AS paper_id, arg_min(r.y, {'s': p.src, 'a': p.age, 'i': r.y}) AS best_paper_id FROM r JOIN p ON p.paper_id = r.y GROUP BY r.x HAVING count(*) > 1
    """,
}
