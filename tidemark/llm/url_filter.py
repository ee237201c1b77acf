"""URL filters over dated lists: entries become validity intervals, captures are judged at their fetch time.

Native DataFrame code only. ``entries`` has ``list_name`` (``block`` or ``allow``), ``kind``, ``pattern``, ``action``
(``add`` or ``remove``) and ``dated``. Kinds: ``host`` (that host), ``domain`` (it and all below it), ``prefix``
(``host/segment/...``, whole path segments).

Defined results: entries with a null or empty field are ignored; of several actions of one entry at the same instant
``remove`` wins; a capture without a URL, host or fetch time matches nothing and is kept; repeated captures give one
row; an entry holds from its instant (included) to the next action (excluded). The longest active pattern decides,
``allow`` wins a tie of length. Other columns of either table are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RULE = ("list_name", "kind", "pattern")


def url_host(url: Column) -> Column:
    """Lower-case host without user information and port; empty where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))


def url_segments(url: Column) -> Column:
    """Non-empty path segments, case kept."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def list_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, kind, pattern, valid_from, valid_to): when each entry was active; ``valid_to`` null while it still is.

    The order window runs per entry and month, and a row per month carries on, so an entry with a long history
    does not land in one task.
    """
    filled = F.lit(True)
    for name in (*RULE, "action"):
        filled = filled & (F.coalesce(F.col(name), F.lit("")) != "")
    dated = (entries.where(filled & F.col("dated").isNotNull() & F.col("action").isin("add", "remove"))
             .groupBy(*RULE, "dated").agg(F.max("action").alias("action"))  # "remove" sorts after "add"
             .withColumn("month", F.trunc("dated", "month")))
    first = dated.groupBy(*RULE, "month").agg(F.min("dated").alias("first"))
    later = first.select(*RULE, "month", F.lead("first").over(Window.partitionBy(*RULE).orderBy("month")).alias("later"))
    within = F.lead("dated").over(Window.partitionBy(*RULE, "month").orderBy("dated"))
    return (dated.withColumn("within", within).join(later, [*RULE, "month"])
            .where(F.col("action") == "add")
            .select(*RULE, F.col("dated").alias("valid_from"), F.coalesce("within", "later").alias("valid_to")))


def _probes(captures: DataFrame, labels: int, segments: int) -> DataFrame:
    """One row per capture and pattern that could match it; no more labels and segments than any entry has."""
    names, parts = F.split("host", r"\."), F.col("segments")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(names), F.lit(max(labels, 1)))),
        lambda n: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(names, -n, n), ".").alias("pattern")))
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(max(segments, 0)))), lambda n: n > 0),
        lambda n: F.struct(F.lit("prefix").alias("kind"),
                           F.concat_ws("/", F.col("host"), F.array_join(F.slice(parts, 1, n), "/")).alias("pattern")))
    own = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern")))
    return (captures.where((F.col("host") != "") & F.col("fetched_at").isNotNull())
            .select("capture", "fetched_at", F.explode(F.concat(own, suffixes, prefixes)).alias("p"))
            .select("capture", "fetched_at", "p.kind", "p.pattern"))


def judge_captures(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url",
                   fetched: str = "fetched_at", bucket_days: int = 32) -> DataFrame:
    """(key, url, fetched_at, n_active, blocked, rule) per distinct capture.

    As-of join: closed intervals are laid out by time bucket and met on (pattern, bucket); an entry has at most one
    open interval, met on the pattern. Intervals of an entry are disjoint, so a capture finds at most one row per
    pattern and list, however many captures a host has.
    """
    rows = (captures.select(F.col(key).alias("id"), F.col(url).alias("address"), F.col(fetched).alias("fetched_at")).distinct()
            .withColumn("host", F.coalesce(url_host(F.col("address")), F.lit("")))
            .withColumn("segments", F.coalesce(url_segments(F.col("address")), F.array().cast("array<string>")))
            .withColumn("capture", F.struct("id", "address", "fetched_at")))
    intervals = list_intervals(entries)
    reach = intervals.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)).alias("segments")).first()
    probes = _probes(rows, reach["labels"] or 0, reach["segments"] or 0)

    def bucket(at: Column) -> Column:
        return F.floor(F.unix_timestamp(at) / (bucket_days * 86400)).cast("long")

    closed = (intervals.where(F.col("valid_to").isNotNull())
              .withColumn("bucket", F.explode(F.sequence(bucket(F.col("valid_from")), bucket(F.col("valid_to"))))))
    met = (probes.withColumn("bucket", bucket(F.col("fetched_at"))).join(closed, ["kind", "pattern", "bucket"])
           .where((F.col("fetched_at") >= F.col("valid_from")) & (F.col("fetched_at") < F.col("valid_to")))
           .select("capture", *RULE))
    still = (probes.join(intervals.where(F.col("valid_to").isNull()), ["kind", "pattern"])
             .where(F.col("fetched_at") >= F.col("valid_from")).select("capture", *RULE))
    rank = F.struct(F.length("pattern").alias("length"), (F.col("list_name") == "allow").alias("allow"), F.col("kind"), F.col("pattern"))
    verdicts = met.unionAll(still).groupBy("capture").agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("best"))
    found = rows.select("capture").join(
        verdicts.select(*[F.col(f"capture.{c}").alias(f"v_{c}") for c in ("id", "address", "fetched_at")], "n", "best"),
        F.col("capture.id").eqNullSafe(F.col("v_id")) & F.col("capture.address").eqNullSafe(F.col("v_address"))
        & F.col("capture.fetched_at").eqNullSafe(F.col("v_fetched_at")), "left")
    return found.select(
        F.col("capture.id").alias(key), F.col("capture.address").alias("url"), F.col("capture.fetched_at").alias("fetched_at"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce(~F.col("best.allow"), F.lit(False)).alias("blocked"),
        F.concat_ws(":", F.when(F.col("best.allow"), F.lit("allow")).when(F.col("best").isNotNull(), F.lit("block")),
                    F.col("best.kind"), F.col("best.pattern")).alias("rule"))
