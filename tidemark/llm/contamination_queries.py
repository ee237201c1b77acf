"""op4: benchmark passages inside the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate
from .common import table
from .registry import query

SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s FROM iw, unnest(range(1, len(w) - least(len(w), 13) + 2)) r(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM dw, lens, unnest(range(1, greatest(len(w) - n + 2, 1))) r(i)),
hit AS (SELECT d.doc_id, d.i, d.n, win.item_id FROM dwin d JOIN win ON win.n = d.n AND win.s = d.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op4_decontaminate", SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=13)
    judged = decontaminate.contamination(index, decontaminate.exact_hits(index), share=20)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
