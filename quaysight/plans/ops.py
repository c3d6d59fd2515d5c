"""Queries over books, options, flows, incidents and executions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incidents as inc
from ..operators import market as mk
from ..operators.normalize import moneyness, tenor
from ..sources import adapters
from ..sources.adapters import SQL as VIEWS
from .market import rounded

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_BPS = ", ".join(f"round(sum(CASE WHEN bid AND price >= mid * (1 - {x} / 10000) THEN quantity ELSE 0 END), 6) AS bid_{x}bps, round(sum(CASE WHEN NOT bid AND price <= mid * (1 + {x} / 10000) THEN quantity ELSE 0 END), 6) AS ask_{x}bps" for x in mk.BPS)


@query(
    f"""WITH {VIEWS['levels']}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol, bid ORDER BY CASE WHEN bid THEN -price ELSE price END, CASE WHEN bid THEN -quantity ELSE quantity END) AS k FROM levels WHERE price > 0 AND quantity > 0), t AS (SELECT * FROM r WHERE k <= 20),
m AS (SELECT symbol, max(CASE WHEN bid THEN price END) AS best_bid, min(CASE WHEN NOT bid THEN price END) AS best_ask, sum(CASE WHEN bid THEN quantity END) AS bid_volume, sum(CASE WHEN NOT bid THEN quantity END) AS ask_volume, count(CASE WHEN bid THEN 1 END) AS bid_levels, count(CASE WHEN NOT bid THEN 1 END) AS ask_levels FROM t GROUP BY 1),
w AS (SELECT *, (best_bid + best_ask) / 2 AS mid FROM m WHERE best_bid IS NOT NULL AND best_ask IS NOT NULL)
SELECT w.symbol, best_bid, best_ask, round(mid, 6) AS mid, bid_volume, ask_volume, round(bid_volume / ask_volume, 6) AS imbalance, CAST(bid_levels AS INT) AS bid_levels, CAST(ask_levels AS INT) AS ask_levels, {_BPS} FROM w JOIN t ON w.symbol = t.symbol GROUP BY ALL"""
)
def agg_book_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08, AGG-09, TOP-01."""
    return rounded(mk.book_snapshot(adapters.book_levels(spark, sf_dir)).drop("bids", "asks"))


_CHAIN = f"{VIEWS['options']}, chain AS (SELECT * FROM options QUALIFY row_number() OVER (PARTITION BY symbol, expiry, strike, option_type ORDER BY seq DESC) = 1)"


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.chain(adapters.options(spark, sf_dir), ["seq"])


@query(f"WITH {_CHAIN} SELECT symbol, expiry, count(DISTINCT strike) AS n_strikes, count(*) AS n_contracts, min(strike) AS min_strike, max(strike) AS max_strike, arg_min(strike, {{'a': abs(strike - underlying), 'b': strike}}) AS atm_strike, round(max(underlying), 6) AS underlying FROM chain GROUP BY 1, 2")
def agg_option_ladders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10, AGG-11."""
    return rounded(mk.ladders(_chain(spark, sf_dir)))


_DAYS = "date_diff('day', DATE '1999-01-01', expiry)"
_TENOR = f"CASE WHEN {_DAYS} <= 7 THEN 'weekly' WHEN {_DAYS} <= 30 THEN 'monthly' WHEN {_DAYS} <= 90 THEN 'quarterly' WHEN {_DAYS} <= 180 THEN 'semi_annual' WHEN {_DAYS} <= 365 THEN 'annual' ELSE 'leap' END"


@query(
    f"""WITH {_CHAIN}, b AS (SELECT symbol, {_TENOR} AS tenor, count(*) AS n, count(DISTINCT expiry) AS e, min(expiry) AS lo, max(expiry) AS hi FROM chain GROUP BY 1, 2)
SELECT symbol, CAST(sum(n) AS BIGINT) AS n_contracts, CAST(sum(e) AS BIGINT) AS n_expiries, min(lo) AS first_expiry, max(hi) AS last_expiry, array_to_string(list_sort(list(tenor || '=' || CAST(n AS VARCHAR))), ',') AS tenors, array_to_string(list_sort(list_filter(['weekly', 'monthly', 'quarterly'], lambda x: NOT list_contains(list(tenor), x))), ',') AS missing_tenors FROM b GROUP BY 1"""
)
def agg_option_chain_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12, AGG-16, PRJ-13, PRJ-14, SET-03."""
    return mk.chain_stats(_chain(spark, sf_dir), tenor(F.date_diff("expiry", F.lit("1999-01-01").cast("date"))))


@query(f"WITH {VIEWS['options']} SELECT CASE WHEN pct <= 5 THEN 'ATM' WHEN pct <= 15 THEN side ELSE 'DEEP_' || side END AS moneyness, option_type, count(*) AS n FROM (SELECT *, abs(strike - underlying) / underlying * 100 AS pct, CASE WHEN (option_type = 'call') = (strike < underlying) AND strike <> underlying THEN 'ITM' ELSE 'OTM' END AS side FROM options) GROUP BY 1, 2")
def prj_moneyness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = adapters.options(spark, sf_dir).withColumn("moneyness", moneyness(F.col("strike"), F.col("underlying"), F.col("option_type")))
    return o.groupBy("moneyness", "option_type").agg(F.count("*").alias("n"))


_STEP = lambda x, hi, lo: f"CASE WHEN {x} > 0.5 THEN {hi} WHEN {x} > 0.2 THEN {lo} ELSE 0 END"


@query(
    f"""WITH {_CHAIN}, g AS (SELECT *, (epoch_us(TIMESTAMP '2001-01-01') - epoch_us(ts)) / 1000000 AS age FROM chain),
f AS (SELECT symbol, expiry, count(*) AS n, count(*) FILTER (age > 86400 * 400) AS stale, count(*) FILTER (delta IS NULL OR gamma IS NULL) AS no_greeks, count(*) FILTER (CASE WHEN option_type = 'call' THEN NOT delta BETWEEN 0 AND 1 ELSE NOT delta BETWEEN -1 AND 0 END) AS bad_delta, count(*) FILTER (gamma < 0) AS bad_gamma, max(age) AS max_age_s FROM g GROUP BY 1, 2),
s AS (SELECT symbol, expiry, strike, max(CASE WHEN option_type = 'call' THEN iv END) AS iv FROM chain GROUP BY 1, 2, 3), t AS (SELECT *, strike - lag(strike) OVER w AS spacing, lag(iv) OVER w AS ivb FROM s WINDOW w AS (PARTITION BY symbol, expiry ORDER BY strike)),
u AS (SELECT *, avg(spacing) OVER (PARTITION BY symbol, expiry) AS m FROM t), v AS (SELECT symbol, expiry, count(*) FILTER (abs(spacing - m) > 0.5 * m) AS strike_gaps, count(*) FILTER (abs(iv / ivb - 1) > 0.2) AS iv_jumps FROM u GROUP BY 1, 2)
SELECT f.symbol, f.expiry, n, stale, no_greeks, bad_delta, bad_gamma, max_age_s, strike_gaps, iv_jumps, round(greatest(0, least(1, 1 - {_STEP('stale / n', 0.4, 0.2)} - {_STEP('no_greeks / n', 0.2, 0.1)} - {_STEP('(bad_delta + bad_gamma) / n', 0.2, 0.1)} - CASE WHEN strike_gaps > 3 THEN 0.1 ELSE 0 END - CASE WHEN iv_jumps > 3 THEN 0.1 ELSE 0 END)), 6) AS score FROM f JOIN v ON f.symbol = v.symbol AND f.expiry = v.expiry"""
)
def agg_surface_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13 to AGG-18."""
    return rounded(mk.surface_quality(_chain(spark, sf_dir), F.lit("2001-01-01").cast("timestamp"), 86400 * 400))


@query(
    f"""WITH {VIEWS['flows']}, wallets AS (SELECT DISTINCT chain, 'wallet' || CAST(i AS VARCHAR) AS a FROM flows, range(10) r(i)), f AS (SELECT *, greatest(value_usd, 0) AS usd, date_trunc('month', ts) AS bucket, (chain, lower(trim(to_address))) IN (SELECT (chain, a) FROM wallets) AS inn, (chain, lower(trim(from_address))) IN (SELECT (chain, a) FROM wallets) AS outt FROM flows),
s AS (SELECT chain, bucket, sum(CASE WHEN usd >= 400000 AND inn THEN usd ELSE 0 END) AS whale_in, sum(CASE WHEN usd >= 400000 AND outt THEN usd ELSE 0 END) AS whale_out, sum(CASE WHEN inn THEN usd ELSE 0 END) AS exchange_in, sum(CASE WHEN outt THEN usd ELSE 0 END) AS exchange_out, count(*) AS tx_count, avg(usd) AS mean_usd, sum(CASE WHEN event_type = 'dex_swap' THEN usd ELSE 0 END) AS dex_volume, sum(CASE WHEN event_type LIKE '%unstake%' THEN -usd WHEN event_type LIKE '%stake%' THEN usd ELSE 0 END) AS tvl_delta FROM f GROUP BY 1, 2),
a AS (SELECT chain, bucket, count(DISTINCT x) AS active_addresses FROM (SELECT chain, bucket, unnest([lower(trim(from_address)), lower(trim(to_address))]) AS x FROM f) WHERE x <> '' GROUP BY 1, 2), r AS (SELECT s.*, active_addresses, sum(tvl_delta) OVER (PARTITION BY s.chain ORDER BY s.bucket) AS tvl FROM s JOIN a ON s.chain = a.chain AND s.bucket = a.bucket),
p AS (SELECT *, lag(tvl) OVER (PARTITION BY chain ORDER BY bucket) AS before FROM r)
SELECT chain, bucket, round(whale_in, 7) AS whale_in, round(whale_out, 7) AS whale_out, round(exchange_in, 7) AS exchange_in, round(exchange_out, 7) AS exchange_out, tx_count, round(mean_usd, 7) AS mean_usd, round(dex_volume, 7) AS dex_volume, round(tvl_delta, 7) AS tvl_delta, active_addresses, round(tvl, 7) AS tvl, round(whale_in - whale_out, 7) AS whale_net, round(exchange_in - exchange_out, 7) AS exchange_net, round(CASE WHEN before > 0 THEN least(greatest(tvl_delta / before * 100, -100), 1000) ELSE 0 END, 7) AS tvl_change_pct FROM p"""
)
def agg_onchain_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-04, AGG-20 to AGG-25."""
    f = adapters.flows(spark, sf_dir)
    wallets = f.select("chain").distinct().withColumn("address", F.explode(F.array(*[F.lit(f"wallet{i}") for i in range(10)])))
    return rounded(mk.flow_features(f, wallets, "month", 400000.0), 7)


@query(
    f"""WITH {VIEWS['flows']}, b AS (SELECT flow_id, chain, flow_id // 100 AS block_number, CASE WHEN flow_id % 1000 < 3 THEN 'alt' ELSE 'main' END AS block_hash, flow_id AS captured FROM flows), tip AS (SELECT chain, max(block_number) AS tip FROM b GROUP BY 1),
n AS (SELECT chain, block_number, max(captured) AS seen, count(DISTINCT block_hash) AS v FROM b GROUP BY 1, 2), r AS (SELECT chain, min(block_number) AS rb, max(seen) AS rs FROM n WHERE v > 1 GROUP BY 1)
SELECT b.flow_id, b.chain, b.block_number, tip - block_number AS depth FROM b JOIN tip ON b.chain = tip.chain LEFT JOIN r ON b.chain = r.chain WHERE block_number <= tip - 12 AND NOT coalesce(block_number >= rb AND captured < rs, false)"""
)
def agg_finalized_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-26."""
    f = adapters.flows(spark, sf_dir).select("flow_id", "chain", F.floor(F.col("flow_id") / 100).alias("block_number"), F.when(F.col("flow_id") % 1000 < 3, "alt").otherwise("main").alias("block_hash"), F.col("flow_id").alias("captured"))
    return mk.finalized(f).select("flow_id", "chain", "block_number", "depth")


_I = VIEWS["incidents"]


@query(f"WITH {_I} SELECT date_trunc('minute', ts) AS bucket, incident_class, count(*) AS n, count(*) FILTER (severity = 'crit') AS crit, count(*) FILTER (severity = 'warn') AS warn FROM incidents GROUP BY 1, 2")
def agg_incident_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.rate(adapters.incidents(spark, sf_dir), "minute")


@query(f"WITH {_I} SELECT date_trunc('hour', ts) AS bucket, incident_class, count(*) AS n, count(*) FILTER (severity = 'crit') AS crit, count(*) FILTER (severity = 'warn') AS warn FROM incidents WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2")
def agg_incident_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.rate(adapters.incidents(spark, sf_dir).where(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")), "hour")


@query(f"WITH {_I} SELECT incident_class, round(avg(value), 6) AS mean, count(value) AS n FROM incidents GROUP BY 1")
def agg_mergeable_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-29, AGG-30: hourly partial sums, merged per class."""
    return rounded(inc.merged(inc.partials(adapters.incidents(spark, sf_dir), ["incident_class"], "value", "hour"), ["incident_class"]))


@query(f"WITH {_I} SELECT incident_class, severity, agent, count(*) AS n, count(*) FILTER (resolved) AS resolved, round(avg(value), 6) AS mean_value FROM incidents GROUP BY 1, 2, 3")
def agg_incident_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(inc.summary(adapters.incidents(spark, sf_dir)))


@query(f"WITH {VIEWS['executions']} SELECT venue, symbol, count(*) AS orders, round(avg(slippage), 6) AS mean_slippage, round(avg(queue), 6) AS mean_queue, round(sum(quantity * price), 4) AS volume, round(sum(fee), 4) AS fees, count(*) FILTER (rejected) AS rejects FROM executions GROUP BY 1, 2")
def agg_execution_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = inc.execution_metrics(adapters.executions(spark, sf_dir))
    return rounded(m.withColumn("volume", F.round("volume", 4)).withColumn("fees", F.round("fees", 4)))


@query(f"WITH {_I} SELECT incident_class AS kind, agent AS entity, round(avg(value), 6) AS mean, max(value) AS largest, min(value) AS smallest, count(*) AS n FROM incidents WHERE incident_class IN ('error', 'view') AND ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2")
def agg_realtime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = adapters.incidents(spark, sf_dir).withColumnsRenamed({"incident_class": "kind", "agent": "entity"})
    return rounded(inc.metrics(m, ["error", "view"], F.lit("2024-01-15").cast("timestamp_ntz")))


@query(f"WITH {_I} SELECT agent, arg_max(severity, {{'a': ts, 'b': incident_id}}) AS severity, arg_max(value, {{'a': ts, 'b': incident_id}}) AS value, max(ts) AS last_ts FROM incidents GROUP BY 1")
def agg_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.latest_state(adapters.incidents(spark, sf_dir), ["agent"], ["severity", "value"], ["ts", "incident_id"])


@query(f"WITH {_I}, r AS (SELECT *, count(*) OVER (PARTITION BY incident_class, agent ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS recent FROM incidents) SELECT incident_id, incident_class, agent, recent FROM r WHERE recent >= 5")
def agg_rate_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.spikes(adapters.incidents(spark, sf_dir), 6 * 3600, 5).select("incident_id", "incident_class", "agent", "recent")


@query(f"WITH {_I}, w AS (SELECT unnest([date_trunc('hour', ts) - INTERVAL 1 HOUR, date_trunc('hour', ts)]) AS start, agent FROM incidents), p AS (SELECT start, agent, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(*) >= 4) SELECT start, count(*) AS agents, CAST(sum(n) AS BIGINT) AS incidents FROM p GROUP BY 1 HAVING count(*) >= 3")
def agg_cascades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-37, STR-11."""
    return inc.cascades(adapters.incidents(spark, sf_dir), "2 hours", "1 hour", 3, 4)


@query(f"WITH {_I} SELECT CAST(ts AS DATE) AS day, incident_class, count(*) FILTER (severity = 'crit') AS breaches, count(*) AS n FROM incidents GROUP BY 1, 2 HAVING count(*) FILTER (severity = 'crit') >= 5")
def agg_sla_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.breaches(adapters.incidents(spark, sf_dir), F.col("severity") == "crit", 5)


@query(f"WITH {_I} SELECT incident_class, l[CAST(floor(n * 0.5) AS INT) + 1] AS p50, l[CAST(floor(n * 0.95) AS INT) + 1] AS p95, l[CAST(floor(n * 0.99) AS INT) + 1] AS p99, n FROM (SELECT incident_class, list_sort(list(value)) AS l, count(*) AS n FROM incidents GROUP BY 1)")
def agg_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.latency(adapters.incidents(spark, sf_dir), ["incident_class"], "value")


@query(f"WITH {_I}, r AS (SELECT incident_id, count(*) OVER (PARTITION BY agent ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND INTERVAL 30 MINUTE FOLLOWING) - 1 AS n FROM incidents) SELECT incident_id, least(n, 50) AS related, n = 0 AS isolated, n > 5 AS burst FROM r")
def join_root_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.root_causes(adapters.incidents(spark, sf_dir)).select("incident_id", "related", "isolated", "burst")


@query(f"WITH {_I} SELECT incident_class, agent, CAST(ts AS DATE) AS day, arg_min(incident_id, {{'a': ts, 'b': incident_id}}) AS incident_id, count(*) AS repeats FROM incidents GROUP BY 1, 2, 3")
def join_repeated_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = adapters.incidents(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return inc.first_of_batch(i, ["incident_class", "agent", "day"]).select("incident_class", "agent", "day", "incident_id", "repeats")


@query(
    f"""WITH RECURSIVE {_I}, o AS (SELECT incident_class, agent, epoch_us(ts) AS us, incident_id, row_number() OVER (PARTITION BY incident_class, agent ORDER BY ts, incident_id) AS k FROM incidents),
e AS (SELECT incident_class, agent, us, incident_id, k, us AS base, true AS emitted FROM o WHERE k = 1 UNION ALL SELECT o.incident_class, o.agent, o.us, o.incident_id, o.k, CASE WHEN o.us - e.base >= 43200000000 THEN o.us ELSE e.base END, o.us - e.base >= 43200000000 FROM e JOIN o ON o.incident_class = e.incident_class AND o.agent = e.agent AND o.k = e.k + 1)
SELECT incident_class, agent, min(us) AS us, arg_min(incident_id, k) AS incident_id, count(*) - 1 AS repeats FROM e GROUP BY incident_class, agent, base"""
)
def str_greedy_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06, ANO-15, FRE-10: at most one incident of a class and agent in twelve hours."""
    return inc.suppressed(adapters.incidents(spark, sf_dir), ["incident_class", "agent"], 12 * 3600)
