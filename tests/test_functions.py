import math

from pyspark.sql import functions as F

from tidemark.functions import clocks, encode, numeric, text


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_missing_tokens_and_numbers(spark):
    got = one(spark, m=clocks.to_number(F.lit("M")), d=clocks.to_number(F.lit("-9999")), n=clocks.to_number(F.lit(" 7.5 ")), j=clocks.to_number(F.lit("1d")))
    assert got == {"m": None, "d": None, "n": 7.5, "j": None}


def test_iso_text_with_offset_and_junk(spark):
    got = one(spark, a=clocks.render_utc(clocks.parse_utc(F.lit("2026-09-13T14:00:00+02:00"))), b=clocks.parse_utc(F.lit("soon")), c=clocks.parse_utc(F.lit("2026-09")))
    assert got == {"a": "2026-09-13T12:00:00Z", "b": None, "c": None}


def test_normal_cdf_matches_erf(spark):
    points = [x / 10 for x in range(-90, 91)]
    rows = spark.createDataFrame([(x,) for x in points], "x double").select("x", numeric.norm_cdf(F.col("x")).alias("p")).collect()
    for row in rows:
        assert abs(row.p - 0.5 * (1 + math.erf(row.x / math.sqrt(2)))) < 1e-13


def test_quantile_inverts_cdf(spark):
    rows = spark.createDataFrame([(p / 1000,) for p in range(1, 1000)], "p double").select("p", numeric.norm_quantile(F.col("p")).alias("z")).collect()
    for row in rows:
        assert abs(0.5 * (1 + math.erf(row.z / math.sqrt(2))) - row.p) < 1e-12


def test_tickers_buckets_and_thresholds(spark):
    b = text.bucket_bounds(F.lit("71° or above"), F.lit(""))
    t = text.hourly_threshold(F.lit("X-T70.99"), F.lit("Will it be above?"))
    got = one(spark, d=clocks.ticker_date(F.lit("KX-26SEP10")).cast("string"), bad=clocks.ticker_date(F.lit("KX-26XXX10")), lo=b["floor"], hi=b["ceil"], th=t["threshold"], side=t["comparison"])
    assert got == {"d": "2026-09-10", "bad": None, "lo": 71.0, "hi": None, "th": 70.99, "side": "above"}


def test_rounding_rules(spark):
    got = one(spark, a=numeric.whole_degree(F.lit(73.5)), b=numeric.whole_degree(F.lit(-2.5)), c=clocks.lead_bucket(F.lit(15.0)), d=numeric.price_cents(F.lit("0.45")), e=numeric.price_cents(F.lit("45")))
    assert got == {"a": 74, "b": -3, "c": 12, "d": 45, "e": 45}


def test_remarks_and_notice(spark):
    r = text.metar_remarks(F.lit("KPHX 010000Z RMK AO2 T10280100 10250 20111 402500111 52012"))
    notice = F.lit("Effective Friday, August 14th, for the 3pm-4pm ET market")
    got = one(spark, t=r["remark_temp_tenths_c"], h=r["remark_24h_max_tenths_c"], c=r["remark_pressure_tendency_code"], n=clocks.render_utc(text.notice_instant(notice, F.lit(2026))))
    assert got == {"t": -2.8, "h": 25.0, "c": 2, "n": "2026-08-14T19:00:00Z"}


def test_standard_offset_ignores_daylight_saving(spark):
    got = one(spark, a=clocks.january_offset_hours(F.lit("2026-07-01").cast("date"), "America/Los_Angeles"), b=clocks.january_offset_hours(F.lit("2026-07-01").cast("date"), "America/Phoenix"))
    assert got == {"a": -8, "b": -7}


def test_ids_and_canonical_json(spark):
    df = spark.createDataFrame([(1, None)], "b int, a string")
    assert df.select(encode.canonical_json(["b", "a"]).alias("j")).first().j == '{"a":null,"b":1}'
    assert df.select(encode.split_ids(F.lit(" x; y,|z ")).alias("i")).first().i == ["x", "y", "z"]
