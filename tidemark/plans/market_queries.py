"""Execution, risk and order-book queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import book, evaluate, joins, market
from . import shapes
from .registry import query
from .shapes import q6, q6_sql, stamp, stamp_sql, table, with_views

def count_rows() -> Column:
    return F.count(F.lit(1))

EDGES = ("edges", """select s.signal_id, s.bucket_probability as fair, c.yes_ask_close as ask, c.yes_bid_close as bid, o.settled_yes,
 s.bucket_probability-least(1e0, c.yes_ask_close+0.005e0+0.02e0*c.yes_ask_close) as yes_edge, 1-s.bucket_probability-greatest(0e0, 1-c.yes_bid_close+0.005e0+0.02e0*(1-c.yes_bid_close)) as no_edge
 from signals s asof join candles c on s.market_ticker=c.market_ticker and s.decision_time_utc>=c.end_period_ts left join outcomes o on o.market_ticker=s.market_ticker where c.yes_ask_close>0 and c.yes_ask_close<1""")


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return market.edges_at_decision(shapes.signals(spark, sf), shapes.candles(spark, sf), shapes.outcomes(spark, sf), 0.01, 0.02, 0.005)


@query("x01_edges_at_decision", with_views(("signals", "candles", "outcomes"), f"select signal_id, {q6_sql('yes_edge')} as yes_edge, {q6_sql('no_edge')} as no_edge, greatest(yes_edge,no_edge)>=0.01e0 as triggered from edges", EDGES))
def edges_at_decision(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(spark, sf).select("signal_id", q6(F.col("yes_edge_after_cost")).alias("yes_edge"), q6(F.col("no_edge_after_cost")).alias("no_edge"), "triggered")


@query("x01_edge_summary", with_views(("signals", "candles", "outcomes"), f"""select count(*) as candidates, count(*) filter (settled_yes is not null) as settled_candidates, {q6_sql("avg(case when settled_yes='yes' then 1e0 when settled_yes='no' then 0e0 end)", 5)} as hit_rate,
 {q6_sql('avg(fair-ask)', 5)} as mean_gross_edge, {q6_sql("sum(case when settled_yes='yes' then 1-ask-0.02e0*ask when settled_yes='no' then -ask-0.02e0*ask end)", 3)} as net_payoff from edges""", EDGES))
def edge_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = market.edge_summary(_edges(spark, sf), 0.02)
    return out.select("candidates", "settled_candidates", q6(F.col("hit_rate"), 5).alias("hit_rate"), q6(F.col("mean_gross_edge"), 5).alias("mean_gross_edge"), q6(F.col("one_contract_net_payoff"), 3).alias("net_payoff"))


FILLS = ("fills", """select s.signal_id, s.decision_time_utc, k.scenario, least(1e0, case k.scenario when 'conservative' then n.yes_ask_high when 'base' then n.yes_ask_close+0.5e0*greatest(0e0,c.yes_ask_close-c.yes_bid_close) else n.yes_ask_open end) as price, o.settled_yes
 from signals s asof join candles c on s.market_ticker=c.market_ticker and s.decision_time_utc>=c.end_period_ts asof join candles n on s.market_ticker=n.market_ticker and s.decision_time_utc<n.end_period_ts
 left join outcomes o on o.market_ticker=s.market_ticker, (values ('conservative'),('base'),('optimistic')) k(scenario) where c.yes_ask_close>0 and c.yes_ask_close<1 and n.yes_ask_open<1 and n.yes_ask_close<1 and n.yes_ask_high<1""")
PAYOFF = "case when settled_yes='yes' then 1-price-0.02e0*price when settled_yes='no' then -price-0.02e0*price end"


def _fills(spark: SparkSession, sf: str) -> DataFrame:
    return market.next_bar_fills(shapes.signals(spark, sf), shapes.candles(spark, sf), shapes.outcomes(spark, sf), 0.02, 0.5)


@query("x02_next_bar_fills", with_views(("signals", "candles", "outcomes"), f"select signal_id, scenario, {q6_sql('price')} as fill_price, {q6_sql(f'coalesce({PAYOFF},-9)')} as payoff from fills", FILLS))
def next_bar_fills(spark: SparkSession, sf: str) -> DataFrame:
    return _fills(spark, sf).select("signal_id", "scenario", q6(F.col("fill_price")).alias("fill_price"), q6(F.coalesce("one_contract_net_payoff", F.lit(-9.0))).alias("payoff"))


@query("x03_fill_summary", with_views(("signals", "candles", "outcomes"), f"""
 , p as (select *, {PAYOFF} as pay from fills where settled_yes is not null), l as (select *, sum(pay) over (partition by scenario order by decision_time_utc, signal_id) as lv from p),
 g as (select *, greatest(max(lv) over (partition by scenario order by decision_time_utc, signal_id), 0) as pk from l)
 select scenario, count(*) as rows, {q6_sql('avg(pay)', 5)} as mean_payoff, {q6_sql('stddev_samp(pay)', 5)} as std_payoff, {q6_sql('avg(pay)/stddev_samp(pay)', 4)} as sharpe_per_trade, {q6_sql('avg(pay)/sqrt(avg(pow(least(0,pay),2)))', 4)} as sortino_per_trade,
 {q6_sql('max(pk-lv)', 3)} as max_drawdown, count(*) filter (pay>0) as wins, {q6_sql('count(*)/(select count(*)*1e0 from signals)', 5)} as fill_rate from g group by 1""", FILLS))
def fill_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = market.fill_summary(_fills(spark, sf), shapes.signals(spark, sf), ["decision_time_utc", "signal_id"])
    return out.select(
        "scenario", "rows", q6(F.col("mean_payoff"), 5).alias("mean_payoff"), q6(F.col("std_payoff"), 5).alias("std_payoff"), q6(F.col("sharpe_per_trade"), 4).alias("sharpe_per_trade"),
        q6(F.col("sortino_per_trade"), 4).alias("sortino_per_trade"), q6(F.col("max_drawdown"), 3).alias("max_drawdown"), "wins", q6(F.col("fill_rate"), 5).alias("fill_rate"))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("market_ticker"), F.col("o_custkey").alias("event_ticker"), ((k * 31 % 97 + 1) / F.lit(99.0)).alias("probability"),
        ((k % 89 + 1) / F.lit(91.0)).alias("price"), F.lit(0.01).alias("fee_rate"))


KELLY = """select k, ev, p, price, net, greatest(0, (p*((1-net)/net)-(1-p))/((1-net)/net)) as kf from (select o_orderkey as k, o_custkey as ev, (o_orderkey*31%97+1)/99e0 as p, (o_orderkey%89+1)/91e0 as price, ((o_orderkey%89+1)/91e0)*(1+0.01e0) as net from orders) where net<1"""


@query("x04_kelly_sizing", f"with c as ({KELLY}) select k as market_ticker, {q6_sql('kf')} as kelly_fraction, least(floor(least(kf*250e0, 50e0)/net), floor(10e0/net)) as contracts from c")
def kelly_sizing(spark: SparkSession, sf: str) -> DataFrame:
    out = candidates(spark, sf).withColumns(market.kelly(F.col("probability"), F.col("price"), 1000.0, fee_rate=F.col("fee_rate"))).where(F.col("contracts").isNotNull())
    return out.select("market_ticker", q6(F.col("kelly_fraction")).alias("kelly_fraction"), "contracts")


@query("x05_event_allocation", f"""with c as ({KELLY}), s as (select *, least(floor(least(kf*1000e0, 1000e0)/net), floor(10e0/net)) as n from c), t as (select *, n*net as al, sum(n*net) over (partition by ev) as tot from s)
 select ev as event_ticker, count(*) as contracts_count, {q6_sql('sum(case when tot>10 then floor(al*10e0/tot/net) else n end)', 3)} as contracts from t group by 1""")
def event_allocation(spark: SparkSession, sf: str) -> DataFrame:
    out = market.allocate_event(candidates(spark, sf), 1000.0).where(F.col("contracts").isNotNull())
    return out.groupBy("event_ticker").agg(count_rows().alias("contracts_count"), q6(F.sum("contracts"), 3).alias("contracts"))


def draws_sql(view: str, sims: int, block: int) -> str:
    return f"""nn as (select strategy, count(*) as n from {view} group by 1), dr as (select nn.strategy, s.i as sim, b.i*{block}+o.i as slot, ((((s.i*7919+b.i*104729+12345)*69069%2147483647)*48271%2147483647)%n+o.i)%n as t from nn, range({sims}) s(i), unnest(range(cast(ceil(n/{block}e0) as bigint))) b(i), range({block}) o(i) where b.i*{block}+o.i<n)"""


#: Draws of the two resampling reports.
BOOTSTRAPS, CHECK_DRAWS = 1000, 2000


@query("x06_block_bootstrap", with_views(("returns",), f""", {draws_sql("returns", BOOTSTRAPS, 5)},
 p as (select strategy, sim, slot, ln(1+value) as l from dr join returns using (strategy, t)), c as (select *, sum(l) over (partition by strategy, sim order by slot) as lv from p), k as (select *, greatest(max(lv) over (partition by strategy, sim order by slot),0) as pk from c),
 e as (select strategy, sim, exp(sum(l))-1 as term from p group by 1,2), d as (select strategy, sim, max(1-exp(lv-pk)) as dd from k group by 1,2), r as (select e.strategy, e.sim, term, dd, row_number() over (partition by e.strategy order by term) as rt, row_number() over (partition by e.strategy order by dd) as rd from e join d using (strategy, sim))
 select strategy, count(*) as simulations, {q6_sql(f'max(term) filter (rt=floor(0.05e0*{BOOTSTRAPS - 1})+1)', 7)} as p05, {q6_sql(f'max(term) filter (rt=floor(0.5e0*{BOOTSTRAPS - 1})+1)', 7)} as p50, {q6_sql(f'max(dd) filter (rd=floor(0.95e0*{BOOTSTRAPS - 1})+1)', 7)} as dd95, {q6_sql('avg(case when term<0 then 1e0 else 0e0 end)', 5)} as loss from r group by 1"""))
def block_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    out = market.block_bootstrap(shapes.returns(spark, sf), BOOTSTRAPS, 5)
    return out.select("strategy", "simulations", q6(F.col("terminal_return_p05"), 7).alias("p05"), q6(F.col("terminal_return_median"), 7).alias("p50"), q6(F.col("max_drawdown_p95"), 7).alias("dd95"), q6(F.col("probability_of_loss"), 5).alias("loss"))


@query("x07_reality_check", with_views(("common_returns",), f""", {draws_sql("(select * from common_returns where strategy='A')", CHECK_DRAWS, 5)},
 ob as (select strategy, avg(value) as m, avg(value)/stddev_samp(value)*sqrt(count(*)) as s from common_returns group by 1), rs as (select sim, r.strategy, avg(value-m)/stddev_samp(value-m)*sqrt(count(*)) as s from (select sim, t from dr) dr join common_returns r using (t) join ob using (strategy) group by 1,2), pk as (select sim, max(s) as s from rs group by 1)
 select (select arg_max(strategy, s) from ob) as best_strategy, {q6_sql('(select max(s) from ob)', 5)} as best_stat, {q6_sql('avg(case when s>=(select max(s) from ob) then 1e0 else 0e0 end)', 5)} as p_value from pk"""))
def reality_check(spark: SparkSession, sf: str) -> DataFrame:
    out = market.reality_check(shapes.common_returns(spark, sf), CHECK_DRAWS, 5)
    return out.select("best_strategy", q6(F.col("best_stat"), 5).alias("best_stat"), q6(F.col("p_value"), 5).alias("p_value"))


@query("x08_ledger_records", with_views(("signals", "candles", "outcomes"), "select scenario, record_type, count(*) as n from (select scenario, unnest(['would_have_order','simulated_fill']) as record_type from fills) group by 1,2", FILLS))
def ledger_records(spark: SparkSession, sf: str) -> DataFrame:
    return market.ledger_records(_fills(spark, sf), "manifests/x").groupBy("scenario", "record_type").agg(count_rows().alias("n"))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("snapshot_id"), F.when(k % 9 != 0, F.create_map(F.lit("a"), (k % 400).cast("double"), F.lit("b"), F.lit(10.0))).alias("feed_age_seconds"),
        F.create_map(F.lit("m"), (k % 30000).cast("double")).alias("model_run_age_seconds"), (k % 4 != 0).alias("probability_consistent"),
        F.when(k % 6 != 0, k % 5 - F.lit(1.5)).alias("clock_drift_seconds"), F.lit(True).alias("orderbook_sequence_gap_resolved"), F.when(k % 10 != 0, F.lit(True)).alias("settlement_rules_verified"),
        (k % 20 / F.lit(100.0)).alias("calibration_error"), F.lit(0.01).alias("daily_drawdown"),
        *[(k % m != 0).alias(n) for n, m in (("positive_oos_net_ev", 3), ("regime_independent", 5), ("probability_perturbation_robust", 7), ("slippage_robust", 11), ("fees_robust", 13),
                                             ("live_paper_matches_backtest", 17), ("outage_killswitch_tested", 19), ("contract_rules_verified", 23))],
        (k % 4).alias("positive_test_windows"), (k % 8 - F.lit(2.0)).alias("brier_improvement"), (k % 12 / F.lit(100.0)).alias("reliability_error"))


@query("x09_readiness_gates", """select k as snapshot_id, array_to_string(list_sort(list_filter([case when k%9=0 then 'missing_feed_age' when k%400>300 then 'stale_feed' end, case when k%30000>21600 then 'stale_model_run' end, case when k%4=0 then 'probability_inconsistent' end,
 case when k%6=0 or abs(k%5-1.5e0)>2 then 'clock_drift' end, case when k%10=0 then 'rules_unverified' end, case when k%20/100e0>0.1e0 then 'calibration_drift' end], lambda x: x is not null)), ';') as reason_codes from (select o_orderkey as k from orders)""")
def readiness_gates(spark: SparkSession, sf: str) -> DataFrame:
    return market.readiness(snapshots(spark, sf)).select("snapshot_id", F.array_join("reason_codes", ";").alias("reason_codes"))


@query("x09_deployment_gate", """select k as snapshot_id, array_to_string(list_filter([case when k%3=0 then 'positive_oos_net_ev' end, case when k%4<2 then 'positive_test_windows' end, case when k%8-2<=0 then 'brier_improvement' end, case when k%12/100e0>0.05e0 then 'reliability_error' end, case when k%5=0 then 'regime_independent' end,
 case when k%7=0 then 'probability_perturbation_robust' end, case when k%11=0 then 'slippage_robust' end, case when k%13=0 then 'fees_robust' end, case when k%17=0 then 'live_paper_matches_backtest' end, case when k%19=0 then 'outage_killswitch_tested' end, case when k%23=0 then 'contract_rules_verified' end], lambda x: x is not null), ';') as failed_checks from (select o_orderkey as k from orders)""")
def deployment_gate(spark: SparkSession, sf: str) -> DataFrame:
    return market.deployment_gate(snapshots(spark, sf)).select("snapshot_id", F.array_join("failed_checks", ";").alias("failed_checks"))


# ---------------------------------------------------------------- order books

SEQUENCED = [
    ("hb", "select *, max(seq) over (partition by sid order by received_ts, event_id rows between unbounded preceding and 1 preceding) as pm, row_number() over (order by received_ts, event_id) as pos from book"),
    ("ac", "select *, coalesce(seq>pm+1,false) as gap, type='orderbook_snapshot' as snap from hb where not coalesce(seq<=pm,false)"),
    ("sq", """select *, coalesce(lg>=fp,false) and not coalesce(ls>=lg,false) as quarantined from (select *, min(pos) over (partition by market_ticker order by pos) as fp, max(case when gap then pos end) over (order by pos) as lg, max(case when snap then pos end) over (partition by market_ticker order by pos) as ls,
 sum(case when snap then 1 else 0 end) over (partition by market_ticker order by pos) as sno from ac)"""),
    ("st", """select market_ticker, sno, pos, 'yes' as side, cast(event_id%4+40 as int) as price, cast(event_id%7+1 as double) as ch from sq where snap union all select market_ticker, sno, pos, 'yes', 39, cast(event_id%5 as double) from sq where snap and event_id%5>0
 union all select market_ticker, sno, pos, 'no', cast(event_id%3+50 as int), cast(event_id%6+1 as double) from sq where snap union all select market_ticker, sno, pos, side, price, delta from sq where not snap and not quarantined"""),
    ("hp", "select *, sum(ch) over (partition by market_ticker, sno, side, price order by pos) as p from st"),
    ("hist", "select market_ticker, sno, pos, side, price, p-least(min(p) over (partition by market_ticker, sno, side, price order by pos),0) as qty from hp"),
    ("lv", "select market_ticker, side, price, arg_max(qty, pos) as qty from hist join (select market_ticker, max(sno) as sno from hist group by 1) using (market_ticker, sno) group by 1,2,3 having arg_max(qty, pos)>0"),
]


def _sequenced(spark: SparkSession, sf: str) -> DataFrame:
    return book.sequence_books(shapes.book_messages(spark, sf))


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return book.current_levels(book.level_history(_sequenced(spark, sf)))


@query("b01_level_history", with_views(("book",), "select market_ticker, side, price, count(*) as steps, sum(qty) as total from hist group by 1,2,3", *SEQUENCED))
def level_history(spark: SparkSession, sf: str) -> DataFrame:
    return book.level_history(_sequenced(spark, sf)).groupBy("market_ticker", "side", "price").agg(count_rows().alias("steps"), F.sum("qty").alias("total"))


@query("b02_quarantine", with_views(("book",), "select market_ticker, count(*) as accepted, count(*) filter (quarantined) as quarantined, count(*) filter (gap) as gaps from sq group by 1", *SEQUENCED))
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return _sequenced(spark, sf).groupBy("market_ticker").agg(count_rows().alias("accepted"), F.count_if("quarantined").alias("quarantined"), F.count_if("accepted_gap").alias("gaps"))


@query("b03_top_of_book", with_views(("book",), f"""
 , t as (select market_ticker, max(row(price,qty)) filter (side='yes') as y, max(row(price,qty)) filter (side='no') as n from lv group by 1)
 select market_ticker, coalesce(cast(y[1] as double),-1) as bid, coalesce(100e0-n[1],-1) as ask, coalesce(y[2],0)+coalesce(n[2],0) as top_depth, {q6_sql('(coalesce(y[2],0)-coalesce(n[2],0))/(coalesce(y[2],0)+coalesce(n[2],0))', 5)} as imbalance from t""", *SEQUENCED))
def top_of_book(spark: SparkSession, sf: str) -> DataFrame:
    out = book.top_of_book(_levels(spark, sf))
    return out.select("market_ticker", F.coalesce("best_yes_bid_cents", F.lit(-1.0)).alias("bid"), F.coalesce("best_yes_ask_cents", F.lit(-1.0)).alias("ask"), "top_depth", q6(F.col("imbalance"), 5).alias("imbalance"))


#: The same steps with deltas of quarantined frames applied, and every frame with the levels live after it.
THROUGH_GAPS = [(n, text.replace(" and not quarantined", "")) for n, text in SEQUENCED if n != "lv"] + [
    ("spans", "select *, coalesce(lead(pos) over (partition by market_ticker, sno, side, price order by pos), 9223372036854775807) as until from hist"),
    ("seen", "select q.event_id, max(row(h.price, h.qty)) filter (h.side='yes') as y, max(row(h.price, h.qty)) filter (h.side='no') as n from sq q join spans h on h.market_ticker=q.market_ticker and h.sno=q.sno and h.pos<=q.pos and q.pos<h.until where h.qty>0 group by 1"),
    ("cl", "select market_ticker, max(received_ts) + to_minutes(90) as close_ts from book where market_ticker%7>0 group by 1"),
]


@query("b03_book_features", with_views(("book",), f"""
 , g as (select *, sum(case when gap then 1 else 0 end) over (order by pos) as gaps from sq), t as (select g.event_id, g.market_ticker, received_ts, gaps, quarantined, y, n, coalesce(y[2],0) as up, coalesce(n[2],0) as down from g left join seen using (event_id))
 select event_id, t.market_ticker, coalesce(cast(y[1] as double),-1) as bid, coalesce(100e0-n[1],-1) as ask, coalesce(100e0-n[1]-y[1],-999) as spread, up+down as top_depth, {q6_sql('coalesce((up-down)/nullif(up+down,0),-9)', 5)} as imbalance, gaps::bigint as sequence_gaps, quarantined,
 {q6_sql('coalesce((epoch_us(close_ts)-epoch_us(received_ts))/60e6,-1)', 4)} as minutes_to_close from t left join cl on cl.market_ticker=t.market_ticker""", *THROUGH_GAPS))
def book_features(spark: SparkSession, sf: str) -> DataFrame:
    closes = shapes.book_messages(spark, sf).where(F.col("market_ticker") % 7 > 0).groupBy("market_ticker").agg((F.max("received_ts") + F.expr("interval 90 minutes")).alias("close_ts"))
    out = book.book_features(_sequenced(spark, sf), closes)
    return out.select(
        "event_id", "market_ticker", F.coalesce("best_yes_bid_cents", F.lit(-1.0)).alias("bid"), F.coalesce("best_yes_ask_cents", F.lit(-1.0)).alias("ask"), F.coalesce("spread_cents", F.lit(-999.0)).alias("spread"), "top_depth",
        q6(F.coalesce("imbalance", F.lit(-9.0)), 5).alias("imbalance"), "sequence_gaps", "quarantined", q6(F.coalesce("minutes_to_close", F.lit(-1.0)), 4).alias("minutes_to_close"))


@query("b04_depth_walk", with_views(("book",), f"""
 , w as (select *, coalesce(sum(qty) over (partition by market_ticker order by price desc rows between unbounded preceding and 1 preceding),0) as b from lv where side='no'), k as (select *, greatest(0, least(qty, 6-b)) as take from w)
 select market_ticker, sum(take) as filled, {q6_sql('sum(take*(100-price)/100e0)', 5)} as gross_cost, 6-sum(take) as remaining from k group by 1""", *SEQUENCED))
def depth_walk(spark: SparkSession, sf: str) -> DataFrame:
    out = book.walk_depth(_levels(spark, sf), 6.0, 0.01)
    return out.select("market_ticker", "filled", q6(F.col("gross_cost"), 5).alias("gross_cost"), "remaining")


FILLS_AT = [
    ("spans", "select *, coalesce(lead(pos) over (partition by market_ticker, sno, side, price order by pos), 9223372036854775807) as until from hist"),
    ("dec", "select event_id as decision_id, market_ticker, received_ts + to_minutes(case when event_id%8=0 then -100000 else 7 end) as dts, cast(event_id%9 as double) as quantity from book"),
    ("dpos", "select decision_id, max(pos) as pos from dec join sq on sq.market_ticker=dec.market_ticker and sq.received_ts<=dts group by 1"),
    ("dladder", """select p.decision_id, quantity, h.price, h.qty, quantity - coalesce(sum(h.qty) over (partition by p.decision_id order by h.price desc rows between unbounded preceding and 1 preceding), 0) as need
 from dpos p join sq on sq.pos=p.pos join dec on dec.decision_id=p.decision_id join spans h on h.market_ticker=sq.market_ticker and h.sno=sq.sno and h.pos<=p.pos and p.pos<h.until where h.side='no' and h.qty>0"""),
    ("dfill", "select decision_id, sum(greatest(0, least(qty, need))) as filled, sum(greatest(0, least(qty, need))*(100-price)/100e0) as gross, count(*) filter (least(qty, need)>0) as fills from dladder group by 1"),
]


@query("b04_fills_at_decisions", with_views(("book",), f"""
 select dec.decision_id, coalesce(sq.quarantined::int, -1) as quarantined, coalesce(filled,0) as filled, {q6_sql('coalesce(gross,0)', 5)} as gross_cost, coalesce(fills,0) as fills, quantity-coalesce(filled,0) as remaining, {q6_sql('coalesce(gross,0)*1.02e0', 5)} as total_cost
 from dec left join dpos using (decision_id) left join sq on sq.pos=dpos.pos left join dfill using (decision_id)""", *[x for x in SEQUENCED if x[0] != "lv"], *FILLS_AT))
def fills_at_decisions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    decisions = shapes.book_messages(spark, sf).select(
        k.alias("decision_id"), "market_ticker", shapes.minutes(F.col("received_ts"), F.when(k % 8 == 0, -100000).otherwise(7)).alias("decision_ts"), (k % 9).cast("double").alias("quantity"))
    out = book.fills_at(decisions, _sequenced(spark, sf), 0.02)
    return out.select(
        "decision_id", F.coalesce(F.col("quarantined").cast("int"), F.lit(-1)).alias("quarantined"), "filled", q6(F.col("gross_cost"), 5).alias("gross_cost"), "fills", "remaining",
        q6(F.col("total_cost"), 5).alias("total_cost"))


@query("b05_capture_audit", with_views(("book",), f"""
 , h as (select *, lag(seq) over (partition by sid order by received_ts, event_id) as p from book)
 select count(*) as session_rows, count(*) filter (type='orderbook_snapshot') as snapshot_count, count(*) filter (seq>p+1) as sequence_gaps, count(*) filter (seq<=p) as sequence_resets, count(distinct market_ticker) as ticker_count, {stamp_sql('min(received_ts)')} as first_received, 0::bigint as ignored_prior_session_rows from h"""))
def capture_audit(spark: SparkSession, sf: str) -> DataFrame:
    out = book.capture_audit(shapes.book_messages(spark, sf))
    return out.select("session_rows", "snapshot_count", "sequence_gaps", "sequence_resets", "ticker_count", stamp(F.col("first_received_ts")).alias("first_received"), "ignored_prior_session_rows")


@query("b06_book_reconciliation", with_views(("book",), """
 , f as (select market_ticker, side, price, arg_min(qty, pos) as qty from hist join (select market_ticker, max(sno) as sno from hist group by 1) using (market_ticker, sno) group by 1,2,3)
 select coalesce(a.market_ticker,b.market_ticker) as market_ticker, count(*) as mismatches from lv a full join f b on a.market_ticker=b.market_ticker and a.side=b.side and a.price=b.price where abs(coalesce(a.qty,0)-coalesce(b.qty,0))>1e-9 group by 1""", *SEQUENCED))
def book_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    history = book.level_history(_sequenced(spark, sf))
    newest = history.groupBy("market_ticker").agg(F.max("snapshot_no").alias("snapshot_no"))
    first = history.join(newest, ["market_ticker", "snapshot_no"]).groupBy("market_ticker", "side", "price").agg(F.min_by("qty", F.struct(*book.ARRIVAL)).alias("qty"))
    diff = joins.reconcile_levels(book.current_levels(history), first, ["market_ticker", "side", "price"])
    return diff.groupBy("market_ticker").agg(count_rows().alias("mismatches"))


@query("e11_price_scenarios", with_views(("signals", "candles", "outcomes"), f"select s.scenario, count(*) as rows, count(*) filter (v>0) as positive_candidates, {q6_sql('avg(v)', 5)} as mean_net_edge, {q6_sql('min(v)', 5)} as min_net_edge, {q6_sql('max(v)', 5)} as max_net_edge from (select unnest([row('yes', yes_edge), row('no', no_edge)]) as r from edges) x, lateral (select r[1] as scenario, r[2] as v) s group by 1", EDGES))
def price_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.price_scenarios(_edges(spark, sf), {"yes": "yes_edge_after_cost", "no": "no_edge_after_cost"})
    return out.select("scenario", "rows", "positive_candidates", *[q6(F.col(c), 5).alias(c) for c in ("mean_net_edge", "min_net_edge", "max_net_edge")])
