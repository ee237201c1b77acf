"""op10: page captures judged by dated URL lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import url_filter
from .common import table
from .registry import query


def captures(pages: DataFrame) -> DataFrame:
    """Pages carry no clock: page n counts as fetched 37 n minutes (modulo 120 days) after the start of 2024."""
    minutes = F.col("page_id") * 37 % (120 * 1440)
    return pages.select("page_id", "url", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))).alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries for hosts, their parent domains, language folders and single pages; a hash of the pattern dates them."""
    host = url_filter.url_host(F.col("url"))
    parts = url_filter.url_segments(F.col("url"))
    kinds = F.array(
        F.struct(F.lit("host").alias("kind"), host.alias("pattern")),
        F.struct(F.lit("domain").alias("kind"), F.regexp_replace(host, r"^[^.]*\.", "").alias("pattern")),
        F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.get(parts, F.lit(0))).alias("pattern")),
        F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(parts, "/")).alias("pattern")))
    patterns = (pages.select(F.explode(kinds).alias("p")).select("p.kind", "p.pattern").distinct()
                .withColumn("u", F.conv(F.substring(F.md5(F.concat_ws(":", "kind", "pattern")), 1, 8), 16, 10).cast("long"))
                .where(F.col("u") % 8 < 5))
    start = F.floor(F.col("u") / 8) % 45
    stop = start + 1 + F.floor(F.col("u") / 512) % 30
    steps = F.array(
        F.struct(F.lit("add").alias("action"), start.alias("day")),
        F.struct(F.lit("remove").alias("action"), stop.alias("day")),
        F.struct(F.when(F.col("u") % 3 == 0, F.lit("add")).otherwise(F.lit("remove")).alias("action"), (stop + 12).alias("day")))
    return (patterns.select(F.when(F.col("u") % 8 == 4, F.lit("allow")).otherwise(F.lit("block")).alias("list_name"),
                            "kind", "pattern", F.explode(steps).alias("s"))
            .select("list_name", "kind", "pattern", "s.action", F.date_add(F.lit("2024-01-01").cast("date"), F.col("s.day").cast("int")).cast("timestamp").alias("dated")))


SQL = r"""
WITH c AS (
  SELECT DISTINCT page_id, url, TIMESTAMP '2024-01-01' + to_minutes(CAST(page_id * 37 % (120 * 1440) AS BIGINT)) AS fetched_at,
    lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')) AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS parts
  FROM pages),
k AS (
  SELECT 'host' AS kind, host AS pattern FROM c UNION SELECT 'domain', regexp_replace(host, '^[^.]*\.', '') FROM c
  UNION SELECT 'prefix', host || '/' || parts[1] FROM c UNION SELECT 'prefix', host || '/' || array_to_string(parts, '/') FROM c),
p AS (SELECT kind, pattern, CAST('0x' || substr(md5(kind || ':' || pattern), 1, 8) AS BIGINT) AS u FROM k WHERE pattern IS NOT NULL),
d AS (
  SELECT CASE WHEN u % 8 = 4 THEN 'allow' ELSE 'block' END AS list_name, kind, pattern, u,
    TIMESTAMP '2024-01-01' + to_days(CAST((u // 8) % 45 AS INTEGER)) AS t1,
    TIMESTAMP '2024-01-01' + to_days(CAST((u // 8) % 45 + 1 + (u // 512) % 30 AS INTEGER)) AS t2
  FROM p WHERE u % 8 < 5),
v AS (
  SELECT list_name, kind, pattern, t1 AS f, t2 AS t FROM d
  UNION ALL SELECT list_name, kind, pattern, t2 + INTERVAL 12 DAY, TIMESTAMP '9999-01-01' FROM d WHERE u % 3 = 0),
m AS (
  SELECT c.page_id, c.url, v.*,
    row_number() OVER (PARTITION BY page_id, url ORDER BY length(pattern) DESC, (list_name = 'allow') DESC, kind DESC, pattern DESC) AS rn,
    count(*) OVER (PARTITION BY page_id, url) AS n
  FROM (SELECT c.*, 'host' AS pk, host AS pp FROM c
        UNION ALL SELECT c.*, 'domain', array_to_string(string_split(host, '.')[i:], '.') FROM c, unnest(range(1, len(string_split(host, '.')) + 1)) r(i)
        UNION ALL SELECT c.*, 'prefix', host || '/' || array_to_string(parts[1:i], '/') FROM c, unnest(range(1, len(parts) + 1)) r(i)) c
  JOIN v ON v.kind = c.pk AND v.pattern = c.pp AND c.fetched_at >= v.f AND c.fetched_at < v.t)
SELECT c.page_id, c.url, strftime(c.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, coalesce(m.n, 0) AS n_active,
  coalesce(m.list_name = 'block', false) AS blocked,
  CASE WHEN m.kind IS NULL THEN '' ELSE m.list_name || ':' || m.kind || ':' || m.pattern END AS rule
FROM c LEFT JOIN m ON m.page_id = c.page_id AND m.url = c.url AND m.rn = 1
"""


@query("op10_url_filter", SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_captures(captures(pages), dated_entries(pages))
    return judged.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"))
