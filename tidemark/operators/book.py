"""Order books from snapshots and deltas, in arrival order.

Everything per subscription or per price level runs as a segmented scan, so one subscription that
carries most frames is spread over its hours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .state import latest_session, sequence_health
from .timeline import Running, asof_join, running_scan, time_segment

ARRIVAL = ["received_ts", "event_id"]
BOOK = ["connection_epoch", "market_ticker", "snapshot_no"]


def sequence_books(messages: DataFrame, oldest: DataFrame | None = None) -> DataFrame:
    """Accepted frames with their book's snapshot number and quarantine flag.

    Stale frames are dropped. A gap taints every known book of the session until that book's next
    snapshot, and frames met while tainted are ignored, except the snapshot that heals. Connection
    epochs must rise with time. ``oldest`` (market_ticker, first_epoch) tells the first session of each
    book when ``messages`` has only some sessions.
    """
    health = sequence_health(messages).where(~F.col("stale"))
    at = F.struct("received_ts", "event_id")
    snapshot = F.col("type") == "orderbook_snapshot"
    gaps = cut_lineage(running_scan(
        health, ["connection_epoch"], ARRIVAL, {
            "last_gap": Running("last", F.when(F.col("accepted_gap"), at)),
            "gap_count": Running("sum", F.col("accepted_gap").cast("int"))}, time_segment("received_ts")))
    books = running_scan(
        gaps, ["connection_epoch", "market_ticker"], ARRIVAL, {
            "last_snapshot": Running("last", F.when(snapshot, at)), "snapshot_no": Running("sum", snapshot.cast("int")),
            "first_frame": Running("min", at)},
        time_segment("received_ts"))
    if oldest is None:
        oldest = health.groupBy("market_ticker").agg(F.min("connection_epoch").alias("first_epoch"))
    books = books.join(oldest, "market_ticker")
    healed = F.coalesce(F.col("last_snapshot") >= F.col("last_gap"), F.lit(False))
    # A gap taints the books that exist by then; a reconnect taints the books of earlier sessions.
    tainted = F.coalesce(F.col("last_gap") >= F.col("first_frame"), F.lit(False)) & ~healed
    carried = (F.col("first_epoch") < F.col("connection_epoch")) & F.col("last_snapshot").isNull()
    return books.withColumn("quarantined", tainted | carried).withColumn(
        "snapshot_no", F.col("snapshot_no").cast("long")).drop("first_frame", "first_epoch")


def level_history(sequenced: DataFrame, through_gaps: bool = False) -> DataFrame:
    """Quantity of each level after every frame that touched it. ``through_gaps`` applies deltas of quarantined frames too.

    Within one snapshot's reign a level is a running sum that is cut off at zero. With P the running
    sum, the cut sum is P less the smallest P so far where that is negative. ``snapshots`` carry
    arrays yes and no of (price, qty); deltas carry side, price and delta.
    """
    keys = ["connection_epoch", "market_ticker", "snapshot_no", "side", "price"]
    snap = sequenced.where(F.col("type") == "orderbook_snapshot")
    pieces = []
    for side in ("yes", "no"):
        pieces.append(snap.select("connection_epoch", "market_ticker", "snapshot_no", *ARRIVAL, F.lit(side).alias("side"), F.explode(side).alias("level")).select(
            "connection_epoch", "market_ticker", "snapshot_no", *ARRIVAL, "side", "level.price", F.col("level.qty").alias("change")).where(F.col("change") > 0))
    known = F.lower("side").isin("yes", "no")
    good = F.assert_true(F.coalesce(known, F.lit(False)), F.lit("unknown order-book side")).isNull()
    delta = sequenced.where((F.col("type") == "orderbook_delta") & (F.lit(through_gaps) | ~F.col("quarantined"))).where(good).select(
        "connection_epoch", "market_ticker", "snapshot_no", *ARRIVAL, F.lower("side").alias("side"), "price", F.col("delta").alias("change"))
    steps = cut_lineage(pieces[0].unionByName(pieces[1]).unionByName(delta))
    path = cut_lineage(running_scan(steps, keys, ARRIVAL, {"__p": Running("sum", F.col("change"))}, time_segment("received_ts")))
    low = running_scan(path, keys, ARRIVAL, {"__low": Running("min", F.col("__p"))}, time_segment("received_ts"))
    return low.select(*keys, *ARRIVAL, (F.col("__p") - F.least(F.col("__low"), F.lit(0.0))).alias("qty"))


def current_levels(history: DataFrame) -> DataFrame:
    """Live levels of every book after the last frame: newest snapshot, last quantity, empty ones gone."""
    newest = history.groupBy("connection_epoch", "market_ticker").agg(F.max("snapshot_no").alias("snapshot_no"))
    last = history.join(newest, ["connection_epoch", "market_ticker", "snapshot_no"]).groupBy(
        "connection_epoch", "market_ticker", "side", "price").agg(F.max_by("qty", F.struct(*ARRIVAL)).alias("qty"))
    return last.where(F.col("qty") > 0)


def top_of_book(levels: DataFrame, keys: Sequence[str] = ("market_ticker",)) -> DataFrame:
    """Best bid, ask (100 less the best NO bid), spread, depth and imbalance of each book."""
    level = F.struct("price", "qty")

    def best(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, level))

    out = levels.groupBy(*keys).agg(best("yes").alias("y"), best("no").alias("n"))
    bid, ask = F.col("y.price").cast("double"), F.lit(100.0) - F.col("n.price")
    up, down = F.coalesce("y.qty", F.lit(0.0)), F.coalesce("n.qty", F.lit(0.0))
    return out.select(
        *keys, bid.alias("best_yes_bid_cents"), ask.alias("best_yes_ask_cents"), (ask - bid).alias("spread_cents"),
        (up + down).alias("top_depth"), ((up - down) / F.nullif(up + down, F.lit(0.0))).alias("imbalance"))


#: Levels that fit one mask: sums of that many powers of two are exact in a long.
MASK_BITS = 50


def _best_level(low: Column, high: Column) -> Column:
    """Greatest price whose bit is set in the masks of prices 0 to 49 and 50 to 99, NULL if none is."""
    top = lambda mask: F.length(F.bin(mask)) - 1
    return F.when(high > 0, top(high) + MASK_BITS).when(low > 0, top(low))


def _held(history: DataFrame, asked: DataFrame) -> DataFrame:
    """Adds ``__held`` to asks (level keys, ``ARRIVAL``): the quantity of the level after that frame."""
    # A frame asks after its own changes.
    both = history.withColumn("__ask", F.lit(0)).unionByName(asked.withColumn("__ask", F.lit(1)), allowMissingColumns=True)
    return running_scan(both, [*BOOK, "side", "price"], [*ARRIVAL, "__ask"], {"__held": Running("last", F.col("qty"))}, time_segment("received_ts")).where(
        F.col("__ask") == 1)


def book_masks(sequenced: DataFrame, through_gaps: bool) -> tuple[DataFrame, DataFrame]:
    """Level history, and after every accepted frame the live prices of each side as two masks.

    A level that comes to life adds its bit and one that dies takes it away, so the mask after any frame is a running sum; no ladder is
    gathered. Prices are whole cents from 0 to 99, others fail the job. ``__frame`` has gap_count and quarantined.
    """
    level, hour = [*BOOK, "side", "price"], time_segment("received_ts")
    inside = F.coalesce(F.col("price").between(0, 2 * MASK_BITS - 1) & (F.col("price") == F.floor("price")), F.lit(False))
    checked = level_history(sequenced, through_gaps).where(F.assert_true(inside, F.lit("order-book price is not a whole cent from 0 to 99")).isNull())
    # A snapshot may list a price twice; its quantities only add up, so the greatest is the last.
    history = cut_lineage(checked.withColumn("price", F.col("price").cast("int")).groupBy(*level, *ARRIVAL).agg(F.max("qty").alias("qty")))
    changes = running_scan(history, level, ARRIVAL, {"__before": Running("last", F.col("qty"), exclusive=True)}, hour)
    flip = (F.col("qty") > 0).cast("long") - (F.coalesce("__before", F.lit(0.0)) > 0).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("price") % MASK_BITS) * flip
    masks = {f"__{side}_{part}": F.when((F.col("side") == side) & (F.floor(F.col("price") / MASK_BITS) == part), bit) for side in ("yes", "no") for part in (0, 1)}
    frames = sequenced.select(*BOOK, *ARRIVAL, F.struct("gap_count", "quarantined").alias("__frame"))
    line = frames.unionByName(changes.select(*BOOK, *ARRIVAL, *[m.alias(n) for n, m in masks.items()]), allowMissingColumns=True)
    line = line.groupBy(*BOOK, *ARRIVAL).agg(F.max("__frame").alias("__frame"), *[F.sum(n).alias(f"{n}_change") for n in masks])
    states = running_scan(line, BOOK, ARRIVAL, {n: Running("sum", F.coalesce(F.col(f"{n}_change"), F.lit(0).cast("long"))) for n in masks}, hour)
    return history, states.select(*BOOK, *ARRIVAL, "__frame", *masks)


def book_features(sequenced: DataFrame, closes: DataFrame | None = None, through_gaps: bool = True) -> DataFrame:
    """Best bid and ask, spread, depth, imbalance and gaps so far after every accepted frame; minutes to ``closes`` (market_ticker, close_ts).

    The best price is the highest bit of a side's mask (``book_masks``), the quantity there the last one of that level, one more
    scan. An empty side has a NULL price and no depth. With ``through_gaps`` deltas met in quarantine count, without it the book
    stays as it was before the gap; ``quarantined`` flags these frames either way.
    """
    history, states = book_masks(sequenced, through_gaps)
    asked = states.select(*BOOK, *ARRIVAL, "__frame", F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), F.coalesce(_best_level(F.col(f"__{side}_0"), F.col(f"__{side}_1")), F.lit(-1)).alias("price")) for side in ("yes", "no")
    ])).alias("__best")).select(*BOOK, *ARRIVAL, "__frame", "__best.*")
    held = _held(history, asked)

    def of(side: str) -> Column:
        return F.max(F.when((F.col("side") == side) & (F.col("price") >= 0), F.struct("price", F.col("__held").alias("qty"))))

    wide = held.groupBy(*BOOK, *ARRIVAL).agg(F.max("__frame").alias("__frame"), of("yes").alias("y"), of("no").alias("n"))
    bid, ask = F.col("y.price").cast("double"), F.lit(100.0) - F.col("n.price")
    up, down = F.coalesce("y.qty", F.lit(0.0)), F.coalesce("n.qty", F.lit(0.0))
    out = wide.select(
        "connection_epoch", "market_ticker", *ARRIVAL, bid.alias("best_yes_bid_cents"), ask.alias("best_yes_ask_cents"), (ask - bid).alias("spread_cents"),
        (up + down).alias("top_depth"), ((up - down) / F.nullif(up + down, F.lit(0.0))).alias("imbalance"),
        F.coalesce("__frame.gap_count", F.lit(0)).cast("long").alias("sequence_gaps"), F.col("__frame.quarantined").alias("quarantined"))
    if closes is None:
        return out
    close = closes.groupBy("market_ticker").agg(F.max("close_ts").alias("__close"))
    minutes = (F.unix_micros("__close") - F.unix_micros("received_ts")) / F.lit(60e6)
    return out.join(close, "market_ticker", "left").withColumn("minutes_to_close", minutes).drop("__close")


def fills_at(decisions: DataFrame, sequenced: DataFrame, fee_rate: float = 0.0, through_gaps: bool = False) -> DataFrame:
    """Cost of buying ``quantity`` YES from the resting NO bids known at each decision, best first.

    ``decisions`` has decision_id (unique), market_ticker, decision_ts and quantity. Its book is that of the last accepted frame
    received by then: the mask of that frame names the live prices, at most 100, and one scan finds their quantities. Decisions after the
    same frame share its ladder. Without a book, and for a quantity that is NULL or not positive, nothing is filled; ``quarantined`` is NULL
    where there is no book.
    """
    history, states = book_masks(sequenced, through_gaps)
    place = {n: F.col(n) for n in ("connection_epoch", "snapshot_no", *ARRIVAL, "__no_0", "__no_1")} | {"quarantined": F.col("__frame.quarantined")}
    renamed = {n if n == "quarantined" else f"__at_{n}": c for n, c in place.items()}
    asked = decisions.select("decision_id", "market_ticker", "decision_ts", F.col("quantity").cast("double").alias("quantity"))
    asked = cut_lineage(asof_join(
        asked, states, ["market_ticker"], F.col("decision_ts"), F.col("received_ts"), renamed, [F.col("connection_epoch"), F.col("event_id")]))
    spot = [*BOOK, *ARRIVAL]
    at = [F.col(n if n == "market_ticker" else f"__at_{n}").alias(n) for n in spot]
    bit = lambda p: F.when(p < MASK_BITS, F.call_function("shiftright", F.col("__at___no_0"), p)).otherwise(
        F.call_function("shiftright", F.col("__at___no_1"), p - MASK_BITS)) % 2 == 1
    prices = F.filter(F.sequence(F.lit(0), F.lit(2 * MASK_BITS - 1)), bit)
    levels = asked.where(F.col("__at_event_id").isNotNull()).select(*at, F.lit("no").alias("side"), F.explode(prices).alias("price")).distinct()
    entry = F.struct((F.lit(100) - F.col("price")).alias("cents"), F.col("__held").alias("qty"))
    ladders = _held(history, levels).groupBy(*spot).agg(F.array_sort(F.collect_list(entry)).alias("__ladder"))
    ladders = ladders.select(*[F.col(n).alias(f"__on_{n}") for n in spot], "__ladder")
    match = F.col("market_ticker") == F.col("__on_market_ticker")
    for n in spot:
        if n != "market_ticker":
            match = match & (F.col(f"__at_{n}") == F.col(f"__on_{n}"))
    wanted = F.greatest(F.coalesce("quantity", F.lit(0.0)), F.lit(0.0))
    start = F.struct(wanted.alias("left"), F.lit(0.0).alias("cost"), F.lit(0).cast("long").alias("fills"))

    def take(a: Column, x: Column) -> Column:
        got = F.least(a["left"], x["qty"])
        return F.struct((a["left"] - got).alias("left"), (a["cost"] + got * x["cents"] / 100).alias("cost"), (a["fills"] + (got > 0).cast("long")).alias("fills"))

    empty = F.array().cast("array<struct<cents:int,qty:double>>")
    walked = asked.join(ladders, match, "left").withColumn("__walk", F.aggregate(F.coalesce("__ladder", empty), start, take))
    cost = F.col("__walk.cost")
    return walked.select(
        "decision_id", "market_ticker", "decision_ts", "quantity", "quarantined", (wanted - F.col("__walk.left")).alias("filled"), cost.alias("gross_cost"),
        F.col("__walk.fills").alias("fills"), F.col("__walk.left").alias("remaining"), (cost * F.lit(fee_rate)).alias("fees"), (cost * F.lit(1.0 + fee_rate)).alias("total_cost"))


def walk_depth(levels: DataFrame, quantity: float, fee_rate: float = 0.0) -> DataFrame:
    """Cost of buying YES from resting NO bids, best first. A book has at most 99 price levels a side."""
    asks = levels.where(F.col("side") == "no").groupBy("market_ticker", "price").agg(F.sum("qty").alias("qty"))
    best_first = Window.partitionBy("market_ticker").orderBy(F.col("price").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("qty").over(best_first), F.lit(0.0))
    take = F.greatest(F.lit(0.0), F.least(F.col("qty"), F.lit(float(quantity)) - before))
    filled = asks.withColumn("take", take).groupBy("market_ticker").agg(
        F.sum("take").alias("filled"), F.sum(F.col("take") * (F.lit(100.0) - F.col("price")) / 100).alias("gross_cost"),
        F.count_if(F.col("take") > 0).alias("fills"))
    return filled.withColumns({
        "remaining": F.lit(float(quantity)) - F.col("filled"), "fees": F.col("gross_cost") * F.lit(fee_rate),
        "total_cost": F.col("gross_cost") * F.lit(1.0 + fee_rate)})


def capture_audit(messages: DataFrame) -> DataFrame:
    """One status row over the newest session: frame types, snapshots, gaps, resets, latency, receipt range."""
    session = latest_session(messages)
    checked = sequence_health(session)
    snapshot = F.col("type") == "orderbook_snapshot"
    populated = snapshot & ((F.size("yes") > 0) | (F.size("no") > 0))
    total = messages.agg(F.count(F.lit(1)).alias("n")).scalar()
    return checked.agg(
        F.count(F.lit(1)).alias("session_rows"), F.count_if(snapshot).alias("snapshot_count"), F.count_if(~snapshot).alias("delta_count"),
        F.count_if(populated).alias("populated_snapshot_count"), F.count_if("gap").alias("sequence_gaps"), F.count_if("reset").alias("sequence_resets"),
        F.countDistinct("market_ticker").alias("ticker_count"), F.min("received_ts").alias("first_received_ts"), F.max("received_ts").alias("last_received_ts"),
    ).withColumn("ignored_prior_session_rows", total - F.col("session_rows"))
