"""DuckDB SQL of the operators that SQL can express over whole tables."""

from __future__ import annotations

#: Documents of the table or of an earlier stage; see ``mixing`` for the method.
MIX = r"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || COALESCE(doc_id::VARCHAR, '-')) AS h
  FROM documents),
src AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
caps AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio,
         (SUM(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total
  FROM src),
levels AS (
  SELECT *, (total - COALESCE(SUM(cap) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / SUM(weight) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM caps),
lev AS (SELECT MAX(lv) AS level FROM levels WHERE ratio >= lv),
targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE LEAST(cap, level * weight) END AS target
  FROM levels CROSS JOIN lev),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN FLOOR(target / source_size * 16777216)::BIGINT ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:source:' || COALESCE(source, chr(0))), 1, 6))::BIGINT AS off
  FROM targets),
line AS (
  SELECT s.doc_id, s.size, r.source_size, r.target,
         ROW_NUMBER() OVER (PARTITION BY s.source ORDER BY s.size, s.h, s.doc_id) * r.rate + r.off AS fin, r.rate
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, ((fin >> 24) - ((fin - rate) >> 24)) * size AS taken
FROM line
"""
