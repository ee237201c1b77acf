"""Secret spans: three fixed patterns, and a randomness battery for any other token. Native DataFrame code only.

A pattern's matches and the text between them come from ``regexp_extract_all`` and ``split``; running sums of
their lengths give the places, in code points. Candidates of the battery are runs of 20 or more token characters.
Each distinct token is tested once: its encoding is inferred (hex, lower or upper alphanumeric, base64), and chi-squared
uniformity over eight slices of that alphabet, the runs test around its middle and the lag-1 serial correlation give
three p-values of being random, combined by Simes' rule. A token is accepted by itself if its p-value reaches a threshold that halves with
every ``HALVING`` symbols beyond ``LONE`` (the longer a token that is not random, the surer the tests tell), whatever else the corpus
holds. Further tokens are accepted per stratum of encoding and length: p-values of random
tokens are uniform, so twice the number above one half estimates how many are random; the threshold is the lowest at which
the others among the accepted, beyond sampling noise, stay below the false-discovery rate. All tokens of the corpus count; this only adds.

Defined results: null and empty texts have no spans; repeated rows get the same spans each; a span of the battery that
lies inside a span of a fixed pattern is not added. Columns other than the key and the text are not looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import norm_cdf
from ..session import cut_lineage

#: The contract's patterns by kind, in the order in which spans of one start are listed.
#: ``least`` is the length that group ``group`` of a match must have; shorter matches are dropped after matching.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # A match of these two is a maximal run, so the least length can stand in the pattern.
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("random", r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
)
ORDER = {kind: i for i, (kind, *_) in enumerate(KINDS)}
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets of the encodings, in the order in which a token is tried against them.
ALPHABETS = (("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"), ("alnum", r"^([0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER),
             ("base64", r".", _DIGITS + _LOWER + _UPPER + "+/"))
SLICES, BINS = 8, 100
#: A token of ``LONE`` symbols is accepted by itself from p = 1/2 on, one of ``HALVING`` more from 1/4 on, and so on down to ``LEAST_P``.
LONE, HALVING, LEAST_P = 24, 8, 0.02


def _row_key(key: str, text: str) -> Column:
    """The same for repeated rows: key, length and hash of the text."""
    return F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.length(text), F.xxhash64(text))


def pattern_matches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, kind, start, stop, token) of every accepted match of ``KINDS``; the kind ``random`` holds candidates."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    found = [
        F.when(F.col(text).rlike(pattern), F.struct(
            F.lit(kind).alias("kind"),
            F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
            F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("sizes"),
            F.lit(least).alias("least")))
        for kind, pattern, group, least in KINDS]
    each = (rows.select(_row_key(key, text).alias("row"), F.filter(F.array(*found), lambda f: f.isNotNull()).alias("found"))
            .where(F.size("found") > 0).select("row", F.explode("found").alias("f"))
            .select("row", "f.kind", "f.least", F.posexplode(F.arrays_zip("f.gaps", "f.hits", "f.sizes")).alias("i", "m"))
            .select("row", "kind", "least", "i", F.col("m.gaps").alias("gap"), F.col("m.hits").alias("token"), F.col("m.sizes").alias("size"))
            .where(F.col("token").isNotNull()).dropDuplicates(["row", "kind", "i"]))
    stop = F.sum(F.col("gap") + F.length("token")).over(Window.partitionBy("row", "kind").orderBy("i"))
    return (each.withColumn("stop", stop).where(F.col("size") >= F.col("least"))
            .select("row", "kind", (F.col("stop") - F.length("token")).alias("start"), "stop", "token"))


def _upper_tail(z: Column) -> Column:
    return 1 - norm_cdf(F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z)))


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds ``encoding`` and ``p`` (the combined p-value of being random) to a table with ``token``."""
    bare = F.regexp_replace(F.translate("token", "-_", "+/"), "=+$", "")
    encoding, folded, alphabet = F.lit(None).cast("string"), bare, F.lit(None).cast("string")
    for name, pattern, letters in reversed(ALPHABETS):
        fits = F.col("bare").rlike(pattern)
        encoding = F.when(fits, F.lit(name)).otherwise(encoding)
        alphabet = F.when(fits, F.lit(letters)).otherwise(alphabet)
    folded = F.when(F.col("encoding") == "base64", F.col("bare")).otherwise(F.lower("bare"))
    df = (tokens.withColumn("bare", bare).withColumn("encoding", encoding).withColumn("alphabet", alphabet)
          .withColumn("x", F.transform(F.split(folded, ""), lambda c: F.instr(F.col("alphabet"), c) - 1))
          .withColumn("x", F.filter("x", lambda v: v >= 0))
          .withColumn("k", F.length("alphabet")).withColumn("n", F.size("x").cast("double")))
    # Chi-squared over slices of the alphabet; slice g holds the symbols whose index falls into its eighth.
    slices = F.transform("x", lambda v: F.floor(v * SLICES / F.col("k")))
    chi = -F.col("n")
    for g in range(SLICES):
        width = F.ceil((g + 1) * F.col("k") / SLICES) - F.ceil(g * F.col("k") / SLICES)
        seen = F.size(F.filter("slices", F.lit(g).eqNullSafe)).cast("double")
        chi = chi + seen * seen * F.col("k") / (F.col("n") * width)
    free = SLICES - 1
    z_chi = (F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / (2 / (9 * free)) ** 0.5
    # Runs above and below the middle of the alphabet.
    df = df.withColumn("slices", slices).withColumn("chi", chi).withColumn("up", F.transform("x", lambda v: v * 2 >= F.col("k")))
    pairs = lambda c, f: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), f)
    turns = F.size(F.filter(pairs(F.col("up"), lambda a, b: a != b), lambda d: d)) + 1
    ups = F.size(F.filter("up", lambda u: u)).cast("double")
    df = df.withColumn("ups", ups).withColumn("expected", 1 + 2 * F.col("ups") * (F.col("n") - F.col("ups")) / F.col("n"))
    spread = (F.col("expected") - 1) * (F.col("expected") - 2) / (F.col("n") - 1)
    # Lag-1 serial correlation.
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    df = (df.withColumn("runs_z", F.when(spread > 0, F.abs(turns - F.col("expected")) / F.sqrt(spread)))
          .withColumn("mean", total(F.col("x")) / F.col("n"))
          .withColumn("off", F.transform("x", lambda v: v - F.col("mean")))
          .withColumn("square", total(F.transform("off", lambda v: v * v))))
    serial = total(pairs(F.col("off"), lambda a, b: a * b)) / F.col("square")
    df = df.withColumn("serial_z", F.when(F.col("square") > 0, F.abs(serial + 1 / F.col("n")) * F.sqrt("n")))
    p = F.array_sort(F.array(_upper_tail(z_chi), F.coalesce(2 * _upper_tail(F.col("runs_z")), F.lit(0.0)),
                             F.coalesce(2 * _upper_tail(F.col("serial_z")), F.lit(0.0))))
    return (df.withColumn("ps", p).withColumn("p", F.least(3 * F.col("ps")[0], 1.5 * F.col("ps")[1], F.col("ps")[2], F.lit(1.0)))
            .select(*tokens.columns, "encoding", "p"))


def accepted_tokens(tokens: DataFrame, rate: float = 0.05) -> DataFrame:
    """Distinct tokens judged random: by themselves, or in their stratum (encoding, doubling length), whose false-discovery rate stays below ``rate``."""
    tested = (randomness(tokens.select("token").distinct())
              .withColumn("stratum", F.concat_ws(":", "encoding", F.floor(F.log2(F.length("token")))))
              .withColumn("bin", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")))
    bins = tested.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n"))
    # Strata times bins rows, whatever the size of the corpus.
    above = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    upper = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)).over(Window.partitionBy("stratum"))
    kept = F.col("kept")
    # One more false token than estimated, less the noise of a count; a few tokens alone prove nothing.
    excess = kept + 1 - 2 * F.col("upper") * (1 - F.col("bin") / BINS) - F.sqrt(F.greatest(F.col("upper") - 4, F.lit(0)))
    limits = (bins.withColumn("kept", F.sum("n").over(above)).withColumn("upper", upper)
              .where((F.col("bin") >= 1) & (F.greatest(excess, F.lit(0.0)) <= rate * kept))
              .groupBy("stratum").agg(F.min("bin").alias("limit")))
    alone = F.greatest(F.lit(LEAST_P), F.pow(F.lit(0.5), 1 + (F.length("token") - LONE) / HALVING))
    lone = (F.length("token") >= LONE) & (F.col("p") >= alone)
    return tested.join(limits, "stratum", "left").where(lone | (F.col("bin") >= F.col("limit"))).select("token")


def secret_spans(docs: DataFrame, rate: float = 0.05, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, spans): per distinct (key, text) its spans (start, rank, kind, stop) in order; ``row`` is ``row_key``."""
    matches = cut_lineage(pattern_matches(docs, key, text))
    fixed = matches.where(F.col("kind") != "random").drop("token")
    candidates = matches.where(F.col("kind") == "random")
    added = candidates.join(accepted_tokens(candidates, rate), "token").select(*fixed.columns)
    rank = F.coalesce(*[F.when(F.col("kind") == kind, F.lit(i)) for kind, i in ORDER.items()])
    spans = fixed.unionAll(added).withColumn("rank", rank)
    # A battery span inside a fixed span starts at or after it and stops no later.
    reach = F.max(F.when(F.col("kind") != "random", F.col("stop"))).over(
        Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0))
    spans = spans.withColumn("reach", reach).where((F.col("kind") != "random") | F.col("reach").isNull() | (F.col("stop") > F.col("reach")))
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "stop"))).alias("spans"))


def scan_secrets(docs: DataFrame, rate: float = 0.05, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, secret_spans) per row; the array is empty where there are none."""
    spans = secret_spans(docs, rate, key, text)
    rows = docs.select(F.col(key), _row_key(key, text).alias("own"))
    return rows.join(spans, rows["own"] == spans["row"], "left").select(
        key, F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("secret_spans"))


def mask_secrets(docs: DataFrame, into: str, rate: float = 0.05, key: str = "doc_id", text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with a column ``into``: the text with its secret spans replaced by ``mask``."""
    spans = secret_spans(docs, rate, key, text)
    # Rows in which no pattern matches have no span and are not shuffled.
    body = F.coalesce(F.col(text), F.lit(""))
    matched = reduce(or_, [body.rlike(pattern) for _, pattern, _, _ in KINDS])
    rows = docs.where(matched).select(F.struct("*").alias("kept"), _row_key(key, text).alias("own"))
    joined = rows.join(spans, rows["own"] == spans["row"], "left").select("kept", "spans", F.col(f"kept.{text}").alias("body"))
    masked = F.when(F.col("spans").isNull(), F.col("body")).otherwise(redact(F.col("body"), F.col("spans"), mask))
    # Only then the columns of docs: in one select, a column of theirs called body would be taken inside the lambdas.
    changed = joined.select("kept", masked.alias("masked")).select("kept.*", F.col("masked").alias(into))
    return docs.where(~matched).select("*", F.col(text).alias(into)).unionAll(changed)


def span_text(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with each stretch of overlapping spans replaced by ``mask``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["stop"]).alias("at"),
            F.when(s["start"] < a["at"], a["parts"]).otherwise(F.concat(
                a["parts"], F.array(F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask)))).alias("parts")),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)
