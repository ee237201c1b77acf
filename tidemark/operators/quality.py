"""Data-quality gates and provenance checks as counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clocks, encode
from .aggregates import clock_status, surplus_rows
from .filters import REASON, all_reasons, first_reason, split
from .state import first_receipt

# Plausible bounds by variable.
BOUNDS = {
    "temperature_2m": (180.0, 350.0), "dewpoint_2m": (150.0, 350.0), "wind_u_10m": (-150.0, 150.0),
    "wind_v_10m": (-150.0, 150.0), "cloud_cover": (0.0, 100.0), "visibility": (0.0, 100000.0),
}


def as_metrics(status: DataFrame, check: str) -> DataFrame:
    """A one-row status as (check, metric, value) rows; booleans count as 0 or 1."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in status.columns]
    return status.select(F.lit(check).alias("check"), F.explode(F.array(*cells)).alias("m")).select("check", "m.metric", "m.value")


def gate_suite(checks: dict[str, DataFrame]) -> DataFrame:
    """All one-row checks side by side; a check passes when its ``pass`` metric is 1."""
    out = None
    for name, status in checks.items():
        part = as_metrics(status, name)
        out = part if out is None else out.unionByName(part)
    return out


def overall(suite: DataFrame) -> DataFrame:
    return suite.where(F.col("metric") == "pass").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("value") == 1.0).alias("passed"), (F.min("value") == 1.0).alias("pass"))


def timestamp_gate(df: DataFrame, raw: Column, parsed: Column, as_of: Column) -> DataFrame:
    return clock_status(df, raw, parsed, as_of)


def duplicate_gate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return surplus_rows(df, keys).withColumn("pass", F.col("duplicates") == 0)


def range_gate(df: DataFrame, variable: str = "variable", value: str = "value", bounds: dict[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    """Rows outside the bounds of their variable, and rows of unknown variables, per variable."""
    known = F.create_map(*[x for k, (lo, hi) in bounds.items() for x in (F.lit(k), F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")))])
    limit = F.try_element_at(known, F.col(variable))
    v = clocks.finite(F.col(value))
    bad = limit.isNull() | v.isNull() | ~F.coalesce(v.between(limit["lo"], limit["hi"]), F.lit(False))
    return df.groupBy(variable).agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("invalid"))


def forecast_run_audit(runs: DataFrame) -> DataFrame:
    """Run keys, clocks and lead of forecast rows, in one status row.

    A run key is (model, city, initialization_time, lead_hours), NULL being a value like any other. A row whose clocks are
    missing counts as a lead mismatch, a missing lead does not; a conflict is a run key with more than one content hash.
    """
    init, valid = F.col("initialization_time"), F.col("valid_time")
    off = F.abs((F.unix_micros(valid) - F.unix_micros(init)) / F.lit(3.6e9) - F.col("lead_hours")) > 0.01
    sha = F.coalesce("sha256", F.lit(""))
    keyed = runs.groupBy("model", "city", "initialization_time", "lead_hours").agg(
        F.count(F.lit(1)).alias("n"), (F.min(sha) != F.max(sha)).alias("conflict"),
        F.count_if(valid.isNull() | init.isNull() | off).alias("off"), F.count_if(F.col("ingested_at") < init).alias("early"))
    return keyed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("unique_run_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_run_keys"), F.count_if("conflict").alias("conflicting_run_keys"),
        F.coalesce(F.sum("off"), F.lit(0)).alias("valid_ne_init_plus_lead"), F.coalesce(F.sum("early"), F.lit(0)).alias("ingested_before_initialization"))


def file_gate(manifest: DataFrame, files: DataFrame, as_of: Column) -> DataFrame:
    """Manifest (path, sha256, bytes, retrieved_at) against found files (path, sha256, bytes)."""
    m = manifest.select("path", F.col("sha256").alias("want"), F.col("bytes").alias("want_bytes"), "retrieved_at", F.lit(True).alias("__m"))
    f = files.select("path", "sha256", "bytes", F.lit(True).alias("__f"))
    wide = m.join(f, "path", "full_outer")
    both = F.col("__m").isNotNull() & F.col("__f").isNotNull()
    return wide.agg(
        F.count("__m").alias("rows"), F.count_if(F.col("__f").isNull()).alias("missing_file"), F.count_if(F.col("__m").isNull()).alias("unindexed_file"),
        F.count_if(both & ~F.coalesce(F.col("want") == F.col("sha256"), F.lit(False))).alias("hash_mismatch"),
        F.count_if(both & (F.col("want_bytes") != F.col("bytes"))).alias("size_mismatch"),
        F.count_if(F.col("__m").isNotNull() & F.col("retrieved_at").isNull()).alias("invalid_receipt"),
        F.count_if(F.col("retrieved_at") > as_of).alias("future_receipt"))


def quarantine_gate(payloads: DataFrame, values: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Payloads without a usable value must be in the reviewed quarantine list.

    ``payloads`` has raw_path and sha256, ``values`` has raw_path per usable value, ``quarantine`` has
    raw_path, sha256, reason, reviewed.
    """
    empty = payloads.join(values.select("raw_path").distinct(), "raw_path", "left_anti")
    good = quarantine.where((F.col("reviewed") == "true") & clocks.first_text(F.col("reason")).isNotNull()).select("raw_path", "sha256").distinct()
    open_rows = empty.join(good, ["raw_path", "sha256"], "left_anti")
    return empty.agg(F.count(F.lit(1)).alias("empty_payload")).withColumn(
        "unquarantined_empty", open_rows.agg(F.count(F.lit(1)).alias("n")).scalar())


def contract_gate(contracts: DataFrame, as_of: Column) -> DataFrame:
    bad = (
        clocks.first_text(F.col("market_ticker").cast("string")).isNull() | F.col("target_time_utc").isNull() | F.col("retrieved_at_utc").isNull()
        | clocks.first_text(F.col("rules_hash")).isNull() | ~F.coalesce(F.col("comparison").isin("above", "below"), F.lit(False)))
    return contracts.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("invalid_rows"), F.count_if(F.col("retrieved_at_utc") > as_of).alias("future_receipts"))


def label_gate(labels: DataFrame) -> DataFrame:
    """Matched labels must be about the exact second, received after it, and agree with the settled result."""
    matched = labels.where(F.col("source_valid_utc").isNotNull())
    second = F.date_trunc("second", "source_valid_utc") == F.date_trunc("second", "target_time_utc")
    observed = F.col("source_observed_yes")
    consistent = ~F.coalesce(F.col("kalshi_result").isin("yes", "no"), F.lit(False)) | (
        observed == F.when(F.col("kalshi_result") == "yes", "true").otherwise("false"))
    return matched.agg(
        F.count(F.lit(1)).alias("matched"), F.count_if(~F.coalesce(second, F.lit(False))).alias("time_mismatch"),
        F.count_if(F.col("label_available_ts") < F.col("source_valid_utc")).alias("received_before_valid"),
        F.count_if(~observed.isin("true", "false")).alias("no_outcome"), F.count_if(~consistent).alias("result_mismatch"))


MANIFEST_FIELDS = (
    "decision_ts", "feature_version", "model_version", "calibrator_version", "source_run_ids", "observation_ids",
    "rules_hash", "code_commit", "prediction", "market_ticker", "target_time_utc",
)


def validate_manifests(manifests: DataFrame, contracts: DataFrame, source_index: DataFrame, observation_index: DataFrame) -> DataFrame:
    """Error codes of each prediction manifest.

    ``no_X``: field X is missing or empty; ``prediction_range``: no probability; ``commit_form``: neither a hash nor HEAD;
    ``contract_unknown``, ``rules_differ``, ``target_differs``: judged by the contract's row; ``unindexed_X``, ``late_X``: an id of kind X.
    Ids are exploded and looked up in their index (id, receipt_time); a missing id or a receipt after
    the decision is an error. ``manifest_id`` identifies the row, the id columns are arrays.
    """
    def lookup(column: str, index: DataFrame, label: str) -> DataFrame:
        ids = manifests.select("manifest_id", F.col("decision_ts").alias("__d"), F.explode(column).alias("id"))
        found = ids.join(index.select("id", "receipt_time", F.lit(True).alias("__hit")), "id", "left")
        error = F.when(F.col("__hit").isNull(), F.lit(f"unindexed_{label}")).when(
            F.col("receipt_time") > F.col("__d"), F.lit(f"late_{label}"))
        return found.groupBy("manifest_id").agg(F.array_sort(F.collect_set(error)).alias(f"__{column}"))

    terms = contracts.select("market_ticker", F.col("rules_hash").alias("__rules"), F.col("target_time_utc").alias("__target"), F.lit(True).alias("__contract"))
    wide = manifests.join(terms, "market_ticker", "left")
    wide = wide.join(lookup("source_run_ids", source_index, "source_run_id"), "manifest_id", "left")
    wide = wide.join(lookup("observation_ids", observation_index, "observation_id"), "manifest_id", "left")
    lists = ("source_run_ids", "observation_ids")
    missing = [(F.col(c).isNull() | (F.size(c) <= 0), f"no_{c}") if c in lists
               else (clocks.first_text(F.col(c).cast("string")).isNull(), f"no_{c}") for c in MANIFEST_FIELDS]
    known = F.col("__contract").isNotNull()
    own = all_reasons(
        *missing,
        (~F.coalesce(clocks.finite(F.col("prediction")).between(0.0, 1.0), F.lit(False)), "prediction_range"),
        (~F.coalesce(F.col("code_commit").rlike("^([0-9a-f]{7,40}|HEAD)$"), F.lit(False)), "commit_form"),
        (~known, "contract_unknown"),
        (known & ~F.coalesce(F.col("rules_hash") == F.col("__rules"), F.lit(False)), "rules_differ"),
        (known & ~F.coalesce(F.col("target_time_utc") == F.col("__target"), F.lit(False)), "target_differs"))
    empty = F.array().cast("array<string>")
    return wide.select("manifest_id", F.concat(own, F.coalesce("__source_run_ids", empty), F.coalesce("__observation_ids", empty)).alias("errors"))


def manifest_key(columns: Sequence[str]) -> Column:
    return encode.content_key(encode.canonical_json(columns))


def manifest_name_gate(manifests: DataFrame, content: Sequence[str], name: str) -> DataFrame:
    """Manifests whose name is not the key of their content, and copies of one content, in one status row."""
    keyed = manifests.select(F.col(name).alias("__name"), manifest_key(content).alias("__key"))
    named = keyed.groupBy("__key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("__name").eqNullSafe(F.col("__key"))).alias("off"))
    return named.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("off"), F.lit(0)).alias("name_mismatch"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_manifests"))


def provenance_indexes(forecasts: DataFrame, observations: DataFrame, stations: Sequence | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source and observation indexes with the first receipt per identity, and rejections.

    ``forecasts``: source_run_id, receipt, initialization, raw_path, raw_sha256. ``observations``:
    station, valid_utc, receipt, raw_path, raw_sha256. Receipts are instants.
    """
    def blank(*names: str) -> Column:
        parts = [F.when(F.col(n).isNull() | (F.trim(F.col(n).cast("string")) == ""), F.lit(n)) for n in names]
        return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull()), "+")

    f = forecasts.withColumn("__blank", blank("source_run_id", "receipt", "raw_sha256", "raw_path"))
    f = f.withColumn(REASON, F.when(F.col("__blank") != "", F.concat(F.lit("missing_"), "__blank"))).drop("__blank")
    good_f, bad_f = split(f)
    sources = first_receipt(good_f, "source_run_id", "receipt", ["initialization", "raw_path", "raw_sha256"])
    o = observations.withColumn("__blank", blank("station", "valid_utc", "raw_sha256", "receipt", "raw_path"))
    outside = ~F.coalesce(F.col("station").isin(*stations), F.lit(False)) if stations is not None else F.lit(False)
    o = o.withColumn(REASON, F.when(outside, F.lit("non_target_station")).when(F.col("__blank") != "", F.concat(F.lit("missing_"), "__blank"))).drop("__blank")
    good_o, bad_o = split(o)
    keyed = good_o.withColumn("observation_id", F.concat_ws(":", F.col("station").cast("string"), clocks.render_utc(F.col("valid_utc")), "raw_sha256"))
    index = first_receipt(keyed, "observation_id", "receipt", ["station", "valid_utc", "raw_sha256"])
    rejected = bad_f.select(F.lit("source").alias("kind"), REASON).unionByName(bad_o.select(F.lit("observation").alias("kind"), REASON))
    return sources, index, rejected.unionByName(sources.where("conflict").select(F.lit("source").alias("kind"), F.lit("conflicting_source_run_metadata").alias(REASON)))


def label_sanity(labels: DataFrame) -> DataFrame:
    """Duplicates, ranges, crossed extremes and missing values of daily labels per city."""
    days = labels.groupBy("city", "date").agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(F.col("tmax_f") < F.col("tmin_f")).alias("__crossed"), F.count_if(F.col("tmax_f").isNull()).alias("__nomax"),
        F.count_if(F.col("tmin_f").isNull()).alias("__nomin"), F.max("tmax_f").alias("__hi"), F.min("tmin_f").alias("__lo"))
    return days.groupBy("city").agg(
        F.sum("__n").cast("long").alias("rows"), F.count(F.lit(1)).alias("unique_dates"), F.sum(F.col("__n") - 1).cast("long").alias("duplicate_dates"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.max("__hi").alias("tmax_top"), F.min("__lo").alias("tmin_bottom"),
        F.sum("__crossed").cast("long").alias("tmax_lt_tmin"), F.sum("__nomax").cast("long").alias("missing_tmax"), F.sum("__nomin").cast("long").alias("missing_tmin"))


def observation_sanity(obs: DataFrame, zone: Column | str) -> DataFrame:
    """Rows, parse rate, rows per day and wrong local dates per station."""
    rows = obs.groupBy("station", "local_date").agg(
        F.count(F.lit(1)).alias("__n"), F.count("tmpf").alias("__t"),
        F.count_if(clocks.local_date(F.col("valid_utc"), zone) != F.col("local_date")).alias("__wrong"))
    return rows.groupBy("station").agg(
        F.sum("__n").cast("long").alias("obs"), (F.sum("__t") * 100 / F.sum("__n")).alias("parse_rate_pct"), F.count(F.lit(1)).alias("local_dates"),
        (F.sum("__n") / F.count(F.lit(1))).alias("obs_per_day"), F.sum("__wrong").cast("long").alias("local_date_mismatch"))


def city_readiness(markets: DataFrame, observations: DataFrame) -> DataFrame:
    """Exact open-time observations, those received by then, and eligibility per city."""
    seen = observations.groupBy("station", "valid_utc").agg(F.max("retrieved_at_utc").alias("retrieved_at_utc"))
    wide = markets.join(seen.withColumnRenamed("valid_utc", "open_time"), ["station", "open_time"], "left")
    hit = F.col("retrieved_at_utc").isNotNull()
    out = wide.groupBy("city").agg(
        F.count(F.lit(1)).alias("market_rows"), F.count_if(F.col("target_time_utc").isNull()).alias("missing_target_time"),
        F.count_if(clocks.first_text(F.col("settlement_source_name")).isNull()).alias("missing_settlement_source"),
        F.count_if(hit).alias("exact_open_time_matches"), F.count_if(F.col("retrieved_at_utc") <= F.col("open_time")).alias("pre_decision_receipts"))
    good = (F.col("exact_open_time_matches") > 0) & (F.col("pre_decision_receipts") > 0) & (F.col("missing_target_time") + F.col("missing_settlement_source") == 0)
    return out.withColumn("reason", F.when(good, "eligible").otherwise("missing_event_terms_or_pre_decision_alignment"))


def completeness(observed: DataFrame, required: DataFrame) -> DataFrame:
    """Required fields each model lacks. Both have model and field; ``required`` is a small list."""
    rows = observed.groupBy("model", "field").agg(F.count(F.lit(1)).alias("rows"))
    wide = required.join(rows, ["model", "field"], "left")
    return wide.groupBy("model").agg(
        F.count(F.lit(1)).alias("required_fields"), F.count("rows").alias("observed_fields"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("rows").isNull(), F.col("field")))), "|").alias("missing_fields"))


def quote_audit(quotes: DataFrame, fields: Sequence[str], expected: DataFrame) -> DataFrame:
    """Quote rows with a non-finite field, and counts against a manifest (expected_rows)."""
    bad = F.lit(False)
    for name in fields:
        bad = bad | clocks.finite(F.col(name)).isNull()
    return quotes.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("non_finite")).withColumn(
        "expected_rows", expected.select("expected_rows").scalar()).withColumn("pass", (F.col("rows") == F.col("expected_rows")) & (F.col("non_finite") == 0))


def unresolved(df: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    """Rows by first broken rule."""
    return df.withColumn(REASON, first_reason(*rules)).where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
