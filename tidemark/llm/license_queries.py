"""op12: license phrases and template blocks in the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses
from .common import table
from .registry import query

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = 0.8


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = (r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
#: All blocks against all templates, without any filter.
SQL = f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
ph AS (SELECT label, {_WORDS.format("said")} AS p FROM (VALUES {", ".join(f"({_literal(p)}, {_literal(n)})" for p, n in PHRASES.items())}) v(said, label)),
pl AS (SELECT r, label, i - 1 AS place FROM dw, ph, unnest(range(1, len(w) + 1)) s(i) WHERE w[i:i + len(p) - 1] = p),
pa AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS said FROM pl GROUP BY r),
tp AS (SELECT label, list_distinct(w) AS t, CAST(pow(2, ceil(log2(len(w)))) AS BIGINT) AS s
       FROM (SELECT label, {_WORDS.format("said")} AS w FROM (VALUES {", ".join(f"({_literal(n)}, {_literal(b)})" for n, b in licenses.TEMPLATES)}) v(label, said))),
bl AS (SELECT r, label, len(list_intersect(t, w[k * s + 1:k * s + 2 * s])) / len(t) AS c
       FROM dw, tp, unnest(range(0, (len(w) - 1) // s + 1)) u(k) WHERE len(w) > 0),
bb AS (SELECT r, max(c) AS c, list(DISTINCT label) AS said FROM bl WHERE c >= {THRESHOLD} - 1e-9 GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(pa.said, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(pa.said, []), coalesce(bb.said, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0.0) END AS score
FROM dw LEFT JOIN pa USING (r) LEFT JOIN bb USING (r)
"""


@query("op12_licenses", SQL)
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score is the greatest containment found: a phrase is contained whole, a block as far as it matches."""
    found = licenses.license_matches(table(spark, sf_dir, "documents"), PHRASES, threshold=THRESHOLD)
    said, near = F.col("places.label"), F.col("blocks.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), F.array_join(F.array_sort(F.array_distinct(said)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(said, near))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"))
