"""Queries that validate, find anomalies and leaks, reconcile sources and rate freshness and quality, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashes
from ..operators import anomaly, leakage, normalize, quality, reconcile, validate
from ..operators.validate import Field, Rule, Schema
from ..sources import adapters
from ..sources.adapters import SQL as VIEWS
from ..sources.adapters import table
from .market import rounded

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- projections


@query("SELECT o_orderkey, CASE WHEN v < 1000000000000 THEN v * 1000000 WHEN v < 1000000000000000 THEN v * 1000 WHEN v < 1000000000000000000 THEN v ELSE v // 1000 END AS us FROM (SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 1000000000 END AS v FROM orders)")
def prj_epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-04: seconds to nanoseconds told apart by size. Micro- and nanoseconds before September 2001 lie in the band of the unit above
    theirs and are read as such."""
    o = table(spark, sf_dir, "orders")
    unit = F.when(F.col("o_orderkey") % 4 == 0, F.lit(1).cast("bigint")).when(F.col("o_orderkey") % 4 == 1, F.lit(1000).cast("bigint")).when(F.col("o_orderkey") % 4 == 2, F.lit(1000000).cast("bigint")).otherwise(F.lit(1000000000).cast("bigint"))
    return o.select("o_orderkey", normalize.epoch_us(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * unit).alias("us"))


@query("WITH s AS (SELECT p_partkey, p_name, upper(replace(p_name, ' ', CASE p_partkey % 3 WHEN 0 THEN '-' WHEN 1 THEN '/' ELSE '' END)) || CASE WHEN p_partkey % 3 = 2 THEN 'USDT' ELSE '' END AS symbol FROM part), c AS (SELECT p_partkey, symbol, CASE WHEN regexp_matches(symbol, '^[A-Z0-9]{2,10}[-_/][A-Z0-9]{2,10}$') THEN regexp_replace(symbol, '[-_/]', '-') WHEN regexp_matches(symbol, '^[A-Z0-9]{2,10}?(USDT|USDC|BUSD|USD|EUR|GBP|BTC|ETH)$') THEN regexp_extract(symbol, '^([A-Z0-9]{2,10}?)(USDT|USDC|BUSD|USD|EUR|GBP|BTC|ETH)$', 1) || '-' || regexp_extract(symbol, '^([A-Z0-9]{2,10}?)(USDT|USDC|BUSD|USD|EUR|GBP|BTC|ETH)$', 2) END AS canonical FROM s) SELECT p_partkey, symbol, canonical, CASE WHEN canonical IS NULL THEN NULL WHEN regexp_matches(symbol, '[-_]') THEN 0.8::DOUBLE ELSE 0.7::DOUBLE END AS confidence, split_part(canonical, '-', 1) AS base FROM c")
def prj_canonical_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-07, PRJ-08."""
    k = F.col("p_partkey") % 3
    joined = F.when(k == 0, F.regexp_replace("p_name", " ", "-")).when(k == 1, F.regexp_replace("p_name", " ", "/")).otherwise(F.concat(F.regexp_replace("p_name", " ", ""), F.lit("USDT")))
    p = table(spark, sf_dir, "part").select("p_partkey", F.upper(joined).alias("symbol"))
    name, sure = normalize.canonical_symbol(F.lit("x"), F.col("symbol"))
    return p.withColumn("canonical", name).withColumn("confidence", sure).withColumn("base", normalize.base_quote(F.col("canonical"))["base"])


@query(f"WITH {VIEWS['trades']} SELECT symbol, array_to_string(list_sort(list(DISTINCT venue)), ',') AS venues, min(ts) AS first_seen, max(ts) AS last_seen, round(greatest(0, least(1, ((epoch_us(TIMESTAMP '2024-01-30') - epoch_us(max(ts))) / 1000000 - 5) / 55)), 6) AS staleness FROM trades WHERE ts < TIMESTAMP '2024-01-30' GROUP BY 1")
def prj_symbol_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapters.trades(spark, sf_dir).where(F.col("ts") < F.lit("2024-01-30").cast("timestamp_ntz"))
    return rounded(normalize.symbol_registry(t, F.lit("2024-01-30").cast("timestamp")).withColumn("venues", F.array_join("venues", ",")))


@query(f"WITH {VIEWS['trades']} SELECT trade_id, sha256(venue || ':' || symbol || ':' || CAST(trade_id AS VARCHAR) || ':' || side) AS identity, CASE WHEN trade_id % 5 = 0 THEN left(md5('symbol=' || symbol || '|venue=null'), 16) ELSE venue || ':' || symbol END AS row_id FROM trades")
def prj_identity_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-19, PRJ-25."""
    t = adapters.trades(spark, sf_dir).withColumn("identity", hashes.joined_hash(F.col("venue"), F.col("symbol"), F.col("trade_id"), F.col("side")))
    t = t.withColumn("venue", F.when(F.col("trade_id") % 5 != 0, F.col("venue")))
    return t.select("trade_id", "identity", hashes.row_identifier(["venue", "symbol"]).alias("row_id"))


@query("SELECT event_id, least(greatest(CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 0 ELSE value END, 1), 50) AS guarded FROM events")
def prj_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-28."""
    bad = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).when(F.col("event_id") % 13 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", normalize.guarded(bad, 0.0, 1.0, 50.0).alias("guarded"))


@query(f"WITH {VIEWS['executions']} SELECT order_id, venue, symbol, queue, signal_us, order_us, order_us - signal_us AS to_order_us, ack_us - order_us AS to_ack_us, fill_us - ack_us AS to_fill_us FROM executions")
def prj_latency_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-30."""
    e = adapters.executions(spark, sf_dir)
    return e.select("order_id", "venue", "symbol", "queue", "signal_us", "order_us", (F.col("order_us") - F.col("signal_us")).alias("to_order_us"), (F.col("ack_us") - F.col("order_us")).alias("to_ack_us"), (F.col("fill_us") - F.col("ack_us")).alias("to_fill_us"))


# --- validation

LINES = Schema(
    "lines",
    (Field("l_orderkey", required=True, low=0), Field("l_quantity", low=2, high=45), Field("l_discount", high=0.09, scale=1), Field("l_returnflag", allowed=("a", "R"), ignore_case=True), Field("l_linestatus", pattern="O|F", max_length=1), Field("l_shipdate", after="1996-01-01", before="2001-06-01", business_hours=True)),
    ("l_orderkey", "l_linenumber"),
    (Rule("arithmetic", "l_extendedprice", lambda: F.col("l_extendedprice") < F.col("l_quantity") * 100), validate.conditional("l_tax", lambda: F.col("l_returnflag") == "R", ["l_tax"])),
)
_LINE_RULES = (
    ("below_minimum", "l_quantity", "error", "l_quantity < 2"),
    ("above_maximum", "l_quantity", "error", "l_quantity > 45"),
    ("above_maximum", "l_discount", "error", "l_discount > 0.09"),
    ("scale_coerced", "l_discount", "warning", "abs(round_even(l_discount, 1) - l_discount) > 1e-7"),
    ("not_allowed", "l_returnflag", "error", "lower(l_returnflag) NOT IN ('a', 'r')"),
    ("too_early", "l_shipdate", "error", "l_shipdate < TIMESTAMP '1996-01-01'"),
    ("too_late", "l_shipdate", "error", "l_shipdate > TIMESTAMP '2001-06-01'"),
    ("outside_business_hours", "l_shipdate", "warning", "isodow(l_shipdate) >= 6 OR NOT hour(l_shipdate) BETWEEN 9 AND 16"),
    ("arithmetic", "l_extendedprice", "error", "l_extendedprice < l_quantity * 100"),
)
_V = "v AS (" + " UNION ALL ".join(f"SELECT l_orderkey, '{k}' AS kind, '{f}' AS field, '{s}' AS severity FROM lineitem WHERE {c}" for k, f, s, c in _LINE_RULES) + ")"


@query(f"WITH {_V} SELECT kind, field, count(*) AS violations, min(l_orderkey) AS first_row FROM v GROUP BY 1, 2")
def val_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-01 to VAL-19, AGG-45."""
    return validate.summary(validate.violations(table(spark, sf_dir, "lineitem"), LINES), "l_orderkey")


@query(f"SELECT count(*) AS rows, count(*) FILTER (ok) AS passed, round(count(*) FILTER (ok) / count(*), 6) AS pass_rate FROM (SELECT NOT ({' OR '.join(f'({c})' for _, _, s, c in _LINE_RULES if s == 'error')}) AS ok FROM lineitem)")
def val_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.totals(validate.violations(table(spark, sf_dir, "lineitem"), LINES))


@query(f"WITH {VIEWS['trades']} SELECT trade_id, symbol, price, quantity FROM trades WHERE price > 1 AND price <= 60 AND quantity > 5 AND abs(price * quantity - round(price * quantity, 2)) <= greatest(1e-6, abs(price * quantity) * 1e-9)")
def val_clean_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-27, VAL-30, QLT-04: the rows that pass, of a split by rules."""
    expected = lambda: F.round(F.col("price") * F.col("quantity"), 2)
    sane = Schema("trades", (Field("price", low=1.0000001, high=60), Field("quantity", low=5.0000001)), (), (Rule("arithmetic", "notional", lambda: F.abs(F.col("price") * F.col("quantity") - expected()) > F.greatest(F.lit(1e-6), F.abs(expected()) * 1e-9)),))
    clean, _ = validate.split(validate.violations(adapters.trades(spark, sf_dir), sane))
    return clean.select("trade_id", "symbol", "price", "quantity")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, k AS occurrence, f AS first_id FROM (SELECT *, row_number() OVER w AS k, first(l_partkey) OVER w AS f FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice)) WHERE k > 1")
def qlt_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT-06."""
    d = validate.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"], "l_partkey")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "occurrence", "first_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1")
def src_newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12."""
    return validate.latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END), 2) AS total FROM lineitem GROUP BY 1 HAVING abs(sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END)) > 0.001")
def qlt_sum_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT-07."""
    signed = table(spark, sf_dir, "lineitem").withColumn("amount", F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")))
    return validate.sums_to_zero(signed, ["l_suppkey"], "amount").withColumn("total", F.round("total", 2))


@query("SELECT event_type, event_id, p AS previous, event_id - p AS step FROM (SELECT *, lag(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM events) WHERE event_id - p <> 1")
def ano_sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-11, QLT-08, QLT-09."""
    return validate.sequence_breaks(table(spark, sf_dir, "events"), ["event_type"], "event_id", ["ts", "event_id"]).select("event_type", "event_id", "previous", "step")


@query(
    """WITH g AS (SELECT event_id, user_id, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000 AS gap_s FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)), e AS (SELECT e.event_id, e.event_type, e.ts, g.gap_s, CASE WHEN g.gap_s > 0 THEN g.gap_s END AS pos FROM events e JOIN g USING (event_id)),
m AS (SELECT *, quantile_cont(pos, 0.5) OVER w AS med, count(pos) OVER w AS n FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)) SELECT * FROM (SELECT event_id, event_type, CASE WHEN gap_s > 3600 THEN 'jump' WHEN gap_s < -60 THEN 'backwards' WHEN n >= 10 AND gap_s > 5 * med THEN 'irregular' END AS kind FROM m) WHERE kind IS NOT NULL"""
)
def val_temporal_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-24, VAL-25."""
    return validate.temporal_jumps(table(spark, sf_dir, "events"), ["event_type"], "ts", ["ts", "event_id"]).select("event_id", "event_type", "kind")


# --- joins


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)")
def join_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-03: rows without a referenced row; null keys are skipped."""
    refs = table(spark, sf_dir, "supplier").where("s_nationkey < 20")
    lines = table(spark, sf_dir, "lineitem").where("l_suppkey is not null")
    return lines.join(refs, lines["l_suppkey"] == refs["s_suppkey"], "left_anti").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")


_TYPO = "CASE p_partkey % 4 WHEN 0 THEN 'x' || substr(p_name, 2) WHEN 1 THEN p_name || 's' WHEN 2 THEN substr(p_name, 1, 3) || substr(p_name, 5) ELSE substr(p_name, 2, 1) || substr(p_name, 1, 1) || substr(p_name, 3) END"


@query(f"WITH v AS (SELECT DISTINCT {_TYPO} AS value FROM part), b AS (SELECT DISTINCT p_name AS valid FROM part), j AS (SELECT value, valid, round(1 - levenshtein(value, valid) / greatest(length(value), length(valid)), 6) AS similarity FROM v, b WHERE value <> valid) SELECT value, valid, similarity FROM (SELECT *, row_number() OVER (PARTITION BY value ORDER BY similarity DESC, valid) AS k FROM j WHERE similarity >= 0.85) WHERE k <= 3")
def join_did_you_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-13: the three most similar valid names of misspelt ones."""
    part = table(spark, sf_dir, "part")
    return validate.did_you_mean(part.select(F.expr(_TYPO).alias("value")), part.select(F.col("p_name").alias("valid")))


@query(f"WITH {VIEWS['trades']}, t AS (SELECT *, date_trunc('hour', ts) AS h FROM trades), f AS (SELECT symbol, h, venue, arg_min(price, {{'a': ts, 'b': trade_id}}) AS price FROM t GROUP BY 1, 2, 3) SELECT a.symbol, a.h AS hour, a.venue AS venue_a, b.venue AS venue_b, round(a.price - b.price, 6) + 0.0 AS difference FROM f a JOIN f b ON a.symbol = b.symbol AND a.h = b.h AND a.venue < b.venue")
def join_cross_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-15: the first price of each venue and hour, in pairs."""
    f = adapters.trades(spark, sf_dir).groupBy("symbol", F.date_trunc("hour", "ts").alias("hour"), "venue").agg(F.min_by("price", F.struct("ts", "trade_id")).alias("price"))
    a, b = f.withColumnsRenamed({"venue": "venue_a", "price": "pa"}), f.withColumnsRenamed({"venue": "venue_b", "price": "pb"})
    return a.join(b, ["symbol", "hour"]).where("venue_a < venue_b").select("symbol", "hour", "venue_a", "venue_b", (F.round(F.col("pa") - F.col("pb"), 6) + 0.0).alias("difference"))


@query(f"WITH {VIEWS['trades']} SELECT symbol, hour, venue, price FROM (SELECT symbol, date_trunc('hour', ts) AS hour, venue, price, row_number() OVER (PARTITION BY symbol, date_trunc('hour', ts) ORDER BY CASE venue WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 9 END, ts DESC, trade_id DESC) AS k FROM trades) WHERE k = 1")
def join_best_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-16: the newest price of the best venue that has one in the hour."""
    rank = F.when(F.col("venue") == "purchase", 1).when(F.col("venue") == "view", 2).when(F.col("venue") == "click", 3).otherwise(9)
    t = adapters.trades(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    return t.groupBy("symbol", "hour").agg(F.max_by(F.struct("venue", "price"), F.struct(-rank, "ts", "trade_id")).alias("r")).select("symbol", "hour", "r.venue", "r.price")


# --- anomalies

_S = "s AS (SELECT event_id AS id, event_type AS k, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)"


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("k"), "ts", "value")


@query(f"WITH {_S}, t AS (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM s WINDOW w AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 549 PRECEDING AND CURRENT ROW)) SELECT id, k, n, round(abs(value - m) / sd, 6) AS z, CASE WHEN abs(value - m) / sd >= 10 THEN 'critical' WHEN abs(value - m) / sd >= 6 THEN 'high' WHEN abs(value - m) / sd >= 4 THEN 'medium' ELSE 'low' END AS severity FROM t WHERE n >= 100 AND sd > 0 AND abs(value - m) / sd > 3")
def ano_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-01, ANO-03, ANO-14."""
    s = anomaly.statistics(_series(spark, sf_dir), ["k"], ["ts", "id"])
    return rounded(anomaly.spikes(s, 3, 100).select("id", "k", "n", "z", "severity"))


@query(f"WITH {_S}, t AS (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM s WINDOW w AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 549 PRECEDING AND CURRENT ROW)), u AS (SELECT *, coalesce(n >= 200 AND sd > 0 AND abs(value - m) / sd > 0.8, false)::INT AS b FROM t), v AS (SELECT *, min(b) OVER w AS mb, count(*) OVER w AS c FROM u WINDOW w AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) SELECT id, k FROM v WHERE mb = 1 AND c = 3")
def ano_debounced_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-05, ANO-06."""
    s = anomaly.statistics(_series(spark, sf_dir), ["k"], ["ts", "id"])
    return anomaly.spikes(s, 0.8, 200, 3, ["k"], ["ts", "id"]).select("id", "k")


@query(f"WITH {_S}, w AS (SELECT a.id, a.k, median(b.value) AS median, mad(b.value) AS mad FROM s a JOIN s b ON a.k = b.k AND b.rn BETWEEN a.rn - 19 AND a.rn GROUP BY 1, 2) SELECT id, k, round(median, 6) AS median, round(mad, 6) AS mad FROM w")
def ano_robust_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-02 over the last 20 values."""
    return rounded(anomaly.mad(_series(spark, sf_dir), ["k"], ["ts", "id"], 20).select("id", "k", "median", "mad"))


@query(f"WITH {_S}, f AS (SELECT *, floor(value / 40) AS v FROM s), c AS (SELECT *, CASE WHEN lag(v) OVER w IS NULL OR abs(v - lag(v) OVER w) > 1e-6 + 1e-9 * abs(lag(v) OVER w) THEN 1 ELSE 0 END AS ch FROM f WINDOW w AS (PARTITION BY k ORDER BY ts, id)), g AS (SELECT *, sum(ch) OVER (PARTITION BY k ORDER BY ts, id) AS grp FROM c) SELECT k, count(*) AS length, min(ts) AS start, max(ts) AS \"end\", CASE WHEN count(*) >= 100 THEN 'critical' WHEN count(*) >= 50 THEN 'high' WHEN count(*) >= 25 THEN 'medium' ELSE 'low' END AS severity FROM g GROUP BY k, grp HAVING count(*) >= 10")
def ano_flatlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-08."""
    return anomaly.flatlines(_series(spark, sf_dir).withColumn("value", F.floor(F.col("value") / 40).cast("double")), ["k"], ["ts", "id"])


@query(f"WITH {_S}, g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000 AS gap_s, abs(value - lag(value) OVER w) AS jump FROM s WINDOW w AS (PARTITION BY k ORDER BY ts, id)) SELECT id, k, gap_s, round(jump, 6) AS jump FROM g WHERE gap_s >= 60 AND jump / gap_s > 0.5")
def ano_discontinuities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-09."""
    return rounded(anomaly.discontinuities(_series(spark, sf_dir), ["k"], ["ts", "id"], 60, 0.5).select("id", "k", "gap_s", "jump"))


@query(f"WITH {_S}, t AS (SELECT *, count(value) OVER o AS n, quantile_cont(value, 0.5) OVER n AS mn, quantile_cont(value, 0.5) OVER o AS mo, mad(value) OVER o AS d FROM s WINDOW n AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), o AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 99 PRECEDING AND 50 PRECEDING)) SELECT id, k, round(mn, 6) AS median_new, round(mo, 6) AS median_old, round(abs(mn - mo) / (1.4826 * d), 6) AS shift FROM t WHERE n = 50 AND abs(mn - mo) / (1.4826 * d) > 0.8")
def ano_level_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-10 with halves of 50 values."""
    return rounded(anomaly.level_shifts(_series(spark, sf_dir), ["k"], ["ts", "id"], 50, 0.8).select("id", "k", "median_new", "median_old", "shift"))


@query(f"WITH {_S}, g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY k, floor(value) ORDER BY ts, id))) / 1000000 AS since_s FROM s) SELECT id, k, since_s FROM g WHERE since_s <= 300")
def ano_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-12, PRJ-24."""
    s = _series(spark, sf_dir).withColumn("floor", F.floor("value"))
    return anomaly.repeats(s, hashes.row_hash(s, ["k", "floor"])).select("id", "k", "since_s")


@query(f"WITH {_S}, g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY k ORDER BY ts, id))) / 1000000 AS gap_s FROM s) SELECT id, k, gap_s, round(gap_s / 1200, 6) AS multiple, CASE WHEN gap_s / 1200 >= 20 THEN 'critical' WHEN gap_s / 1200 >= 10 THEN 'high' WHEN gap_s / 1200 >= 5 THEN 'medium' ELSE 'low' END AS severity FROM g WHERE gap_s > 1800")
def ano_missing_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-13."""
    return rounded(anomaly.gaps(_series(spark, sf_dir), ["k"], ["ts", "id"], 1200).select("id", "k", "gap_s", "multiple", "severity"))


@query(
    f"""WITH RECURSIVE {_S}, w AS (SELECT id, k, rn, value, count(*) OVER o AS n, avg(value) OVER o AS m, stddev_samp(value) OVER o AS sd FROM s WINDOW o AS (PARTITION BY k ORDER BY rn ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
c AS (SELECT *, 3.0 * (1 + 0.5 * CASE WHEN m <> 0 THEN least(sd / abs(m), 1) ELSE 1 END) AS base, CASE WHEN n = 100 AND sd > 0 THEN abs(value - m) / sd END AS z FROM w),
r AS (SELECT id, k, rn, value, z, base::DOUBLE AS threshold, false AS breach, [0] AS hits FROM c WHERE rn = 1
UNION ALL SELECT id, k, rn, value, z, threshold, coalesce(z > threshold, false), (hits || [coalesce(z > threshold, false)::INT])[-20:] FROM (SELECT c.id, c.k, c.rn, c.value, c.z, c.base * (1 + 0.5 * least(list_sum(r.hits) / 20, 0.5)) AS threshold, r.hits FROM r JOIN c ON c.k = r.k AND c.rn = r.rn + 1))
SELECT k, id, value, round(z, 6) AS z, round(threshold, 6) AS threshold FROM r WHERE breach"""
)
def ano_adaptive_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-04: the threshold depends on the breaches before."""
    return rounded(anomaly.adaptive(_series(spark, sf_dir), ["k"], ["ts", "id"]))


# --- leakage

_RATE = lambda hits, n: f"{hits} / {n} AS ratio, 1 / (1 + exp(-({hits} / {n}) * sqrt({n}))) AS confidence"
_SEV = "CASE WHEN ratio * confidence >= 0.2 THEN 'critical' WHEN ratio * confidence >= 0.05 THEN 'high' WHEN ratio * confidence >= 0.01 THEN 'medium' ELSE 'low' END AS severity"


@query(f"WITH j AS (SELECT epoch_us(o_orderdate) - (epoch_us(l_shipdate) - 86450000000 * 30) AS late FROM orders JOIN lineitem ON o_orderkey = l_orderkey), a AS (SELECT count(*) AS n, count(*) FILTER (late > 0) AS violations, max(CASE WHEN late > 0 THEN late / 1000 END) AS max_ms FROM j), r AS (SELECT *, {_RATE('violations', 'n')} FROM a) SELECT n, violations, max_ms, round(ratio, 6) AS ratio, round(confidence, 6) AS confidence, {_SEV} FROM r")
def leak_look_ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-01, JOIN-01."""
    f, labels = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key"), table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key")
    return rounded(leakage.look_ahead(f, labels, "key", "o_orderdate", "l_shipdate", 86450 * 30, 0.0))


_PAIRS = "SELECT x.g AS a, y.g AS b, x.n AS size_a, y.n AS size_b, coalesce(p.s, 0) AS shared, round(coalesce(p.s, 0) / least(x.n, y.n), 6) AS ratio, round(coalesce(p.s, 0) / (x.n + y.n - coalesce(p.s, 0)), 6) AS jaccard FROM z x JOIN z y ON x.g < y.g LEFT JOIN p ON p.a = x.g AND p.b = y.g"


@query(f"WITH d AS (SELECT DISTINCT doc_id % 3 AS g, md5(text) AS h FROM documents), z AS (SELECT g, count(*) AS n FROM d GROUP BY 1), p AS (SELECT d.g AS a, e.g AS b, count(*) AS s FROM d JOIN d e ON d.h = e.h AND d.g < e.g GROUP BY 1, 2) {_PAIRS}")
def leak_split_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-02, SET-01, SET-02, JOIN-12."""
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 3).alias("split"), "text")
    return rounded(leakage.shared(d, "split", F.md5(F.col("text").cast("binary"))))


@query(f"WITH d AS (SELECT DISTINCT doc_id % 4 AS g, source AS h FROM documents), z AS (SELECT g, count(*) AS n FROM d GROUP BY 1), p AS (SELECT d.g AS a, e.g AS b, count(*) AS s FROM d JOIN d e ON d.h = e.h AND d.g < e.g GROUP BY 1, 2) {_PAIRS}")
def leak_fold_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-04."""
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 4).alias("fold"), "source")
    return rounded(leakage.shared(d, "fold", F.col("source")))


@query("WITH r AS (SELECT day(ts) % 4 AS f, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1) SELECT x.f AS a, y.f AS b, round((greatest(epoch_us(x.lo), epoch_us(y.lo)) - least(epoch_us(x.hi), epoch_us(y.hi))) / 3.6e9, 6) AS gap_hours, (greatest(epoch_us(x.lo), epoch_us(y.lo)) - least(epoch_us(x.hi), epoch_us(y.hi))) / 3.6e9 < 24 AS violation FROM r x JOIN r y ON x.f < y.f")
def leak_fold_embargo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-05."""
    return rounded(leakage.embargo(table(spark, sf_dir, "events").withColumn("fold", F.dayofmonth("ts") % 4), "fold", "ts"))


@query(f"WITH {VIEWS['executions']}, d AS (SELECT (ack_us - order_us) / 1000 AS d FROM executions WHERE ack_us >= order_us), s AS (SELECT greatest(1.0, least(100.0, 0.5 * quantile_cont(d, 0.01))) AS limit_ms FROM d), a AS (SELECT limit_ms, count(*) FILTER (d < limit_ms) AS faster, count(*) AS n FROM d, s GROUP BY 1), r AS (SELECT *, {_RATE('faster', 'n')} FROM a) SELECT CAST(limit_ms AS DOUBLE) AS limit_ms, faster, n, round(ratio, 6) AS ratio, round(confidence, 6) AS confidence, {_SEV} FROM r")
def leak_timing_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-03."""
    return rounded(leakage.timing_edge(adapters.executions(spark, sf_dir), (F.col("ack_us") - F.col("order_us")) / 1000).drop("p"))


@query(f"WITH {VIEWS['executions']}, a AS (SELECT 120000.0 AS limit_ms, count(*) FILTER ((fill_us - ack_us) / 1000 < 120000) AS faster, count(*) AS n FROM executions WHERE fill_us >= ack_us), r AS (SELECT *, {_RATE('faster', 'n')} FROM a) SELECT CAST(limit_ms AS DOUBLE) AS limit_ms, faster, n, round(ratio, 6) AS ratio, round(confidence, 6) AS confidence, {_SEV} FROM r")
def leak_execution_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-07, LEAK-08."""
    return rounded(leakage.timing_edge(adapters.executions(spark, sf_dir), (F.col("fill_us") - F.col("ack_us")) / 1000, 120000.0).drop("p"))


_COPY = lambda f, x: f"SELECT '{f}' AS feature, {x} AS x, l_extendedprice AS y FROM lineitem"


@query(f"WITH u AS ({' UNION ALL '.join(_COPY(f, x) for f, x in (('l_quantity', 'l_quantity'), ('l_discount', 'l_discount'), ('l_tax', 'l_tax'), ('copy', 'l_extendedprice')))}), a AS (SELECT feature, avg((abs(x - y) <= 1e-10)::INT) AS equal_rate, abs(corr(x, y)) AS correlation, avg(abs(x - y)) / stddev_pop(y) AS nmae FROM u GROUP BY 1) SELECT feature, round(equal_rate, 6) AS equal_rate, round(correlation, 6) AS correlation, round(nmae, 6) AS nmae, equal_rate > 0.95 OR (equal_rate > 0.1 AND correlation > 0.99) OR nmae < 0.1 AS leak FROM a")
def leak_target_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-06."""
    lines = table(spark, sf_dir, "lineitem").withColumn("copy", F.col("l_extendedprice"))
    return rounded(leakage.target_copies(lines, ["l_quantity", "l_discount", "l_tax", "copy"], "l_extendedprice"))


# --- reconciliation and freshness

_AB = "a AS (SELECT o_orderkey AS k, o_totalprice AS total, o_orderdate AS at FROM orders), b AS (SELECT l_orderkey AS k, round(sum(l_extendedprice), 2) AS total, min(l_shipdate) AS at FROM lineitem GROUP BY 1), j AS (SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS ina, b.k IS NOT NULL AS inb, a.total AS ta, b.total AS tb, a.at AS aa, b.at AS ab FROM a FULL JOIN b ON a.k = b.k), d AS (SELECT k, 'missing_in_a' AS kind, NULL AS field FROM j WHERE NOT ina UNION ALL SELECT k, 'missing_in_b', NULL FROM j WHERE NOT inb UNION ALL SELECT k, 'value_mismatch', 'total' FROM j WHERE ina AND inb AND abs(ta - tb) > greatest(1e-6, 1e-9 * greatest(abs(ta), abs(tb))) UNION ALL SELECT k, 'timestamp_drift', 'at' FROM j WHERE ina AND inb AND abs(epoch_us(aa) - epoch_us(ab)) > 1000000)"


def _discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("at"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"), F.min("l_shipdate").alias("at"))
    return reconcile.rated(reconcile.compare(a, b, ["k"], ["total", "at"], times=("at",)), 2, 1)


@query(f"WITH {_AB} SELECT k, kind, field, CASE kind WHEN 'timestamp_drift' THEN 'low' ELSE CASE WHEN kind = 'value_mismatch' OR kind = 'missing_in_a' THEN 'high' ELSE 'medium' END END AS severity, 'take_a' AS fix FROM d")
def rec_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-01, REC-02, REC-04, REC-06, REC-08, JOIN-05, JOIN-06."""
    return _discrepancies(spark, sf_dir).select("k", "kind", "field", "severity", "fix")


@query(f"WITH {_AB} SELECT kind, coalesce(field, '') AS field, CASE kind WHEN 'timestamp_drift' THEN 'low' ELSE CASE WHEN kind = 'value_mismatch' OR kind = 'missing_in_a' THEN 'high' ELSE 'medium' END END AS severity, count(*) AS n FROM d GROUP BY 1, 2, 3")
def rec_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-09, AGG-48."""
    return reconcile.report(_discrepancies(spark, sf_dir))


@query("WITH b AS (SELECT l_orderkey AS k, min(l_shipdate) AS vb FROM lineitem GROUP BY 1), c AS (SELECT o_orderkey AS k, o_orderdate AS va, vb FROM orders JOIN b ON o_orderkey = k), r AS (SELECT k, row_number() OVER (ORDER BY va, k) - 1 AS rank_va, row_number() OVER (ORDER BY vb, k) - 1 AS rank_vb FROM c) SELECT * FROM r WHERE rank_va <> rank_vb")
def rec_order_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-05, TOP-03."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), us(F.col("o_orderdate")).alias("at"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(us(F.min("l_shipdate")).alias("at"))
    return reconcile.order_differences(a, b, "k", "at")


@query(f"WITH {_S}, g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY k ORDER BY ts, id))) / 1000000 AS gap_s FROM s), p AS (SELECT *, CASE WHEN gap_s > 0 THEN gap_s END AS pos FROM g), w AS (SELECT *, avg(gap_s) OVER a AS mean_gap, stddev_samp(gap_s) OVER a AS sd_gap, quantile_cont(pos, 0.5) OVER b AS bar, mad(pos) OVER b AS d FROM p WINDOW a AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), b AS (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)), x AS (SELECT *, 1.4826 * d AS jitter, rn >= 10 OR coalesce(rn >= 3 AND sd_gap / mean_gap < 0.2, false) AS armed FROM w) SELECT id, k, armed, round(mean_gap, 2) AS mean_gap, round(bar, 2) AS bar, round(jitter, 2) AS jitter, round(CASE WHEN NOT armed THEN 2 * 600 ELSE coalesce(greatest(10, least(3600, 1.5 * bar + 2 * jitter)), greatest(10, least(3600, 1.5 * 600))) END, 2) AS threshold_s FROM x")
def fre_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-01, FRE-02, FRE-05."""
    s = reconcile.intervals(_series(spark, sf_dir), "k").withColumn("threshold_s", reconcile.threshold(F.col("bar"), F.col("jitter"), F.lit(600.0), F.col("armed")))
    return rounded(s.select("id", "k", "armed", "mean_gap", "bar", "jitter", "threshold_s"), 2)


@query("WITH t AS (SELECT h.ts AS tick, s.k FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 01:00:00', TIMESTAMP '2024-01-30 00:00:00', INTERVAL 1 HOUR)) AS ts) h, (SELECT DISTINCT event_type AS k FROM events) s), j AS (SELECT t.k, t.tick, (epoch_us(t.tick) - epoch_us(e.ts)) / 1000000 AS age FROM t ASOF LEFT JOIN (SELECT DISTINCT event_type AS k, ts FROM events) e ON t.k = e.k AND t.tick >= e.ts) SELECT k, CASE WHEN age <= 600 THEN 'fresh' WHEN age <= 1200 THEN 'stale' WHEN age <= 2400 THEN 'very_stale' ELSE 'critical' END AS level, count(*) AS n, round(sum(CASE WHEN age IS NULL THEN 0.9 WHEN age < -5 THEN 0.8 WHEN age <= 300 THEN 1.0 WHEN age <= 600 THEN 0.98 WHEN age <= 900 THEN 0.95 WHEN age <= 1200 THEN 0.92 WHEN age <= 1500 THEN 0.9 ELSE 0.85 END), 4) AS score FROM j GROUP BY 1, 2")
def fre_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-03, FRE-04, FRE-11: ages at hourly checks."""
    from ..operators.asof import asof

    obs = _series(spark, sf_dir).select("k", F.col("ts").alias("tick"), "id")
    hours = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"), F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR"))).alias("tick"))
    j = asof(hours.join(obs.select("k").distinct()), obs, "tick", ["k"], ["id"])
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    j = j.withColumn("age", (us("tick") - us("matched_ts")) / 1000000)
    return j.groupBy("k", reconcile.level(F.col("age"), F.lit(600.0)).alias("level")).agg(F.count("*").alias("n"), F.round(F.sum(reconcile.score(F.col("age"), "analysis")), 4).alias("score"))


@query("SELECT e.event_id AS id FROM events e WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT event_type, date_trunc('day', ts) AS s FROM events) p WHERE p.event_type = e.event_type AND e.ts >= p.s AND epoch_us(e.ts) <= epoch_us(p.s + INTERVAL 2 HOUR) + 30000000)")
def fre_planned_pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-08: pauses are the first two hours of each day."""
    s = _series(spark, sf_dir)
    pauses = s.select("k", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("start")).distinct().withColumn("end", F.col("start") + F.expr("INTERVAL 2 HOURS"))
    return reconcile.outside_pauses(s, pauses, "k", "ts").select("id")


@query("SELECT weekofyear(ts) AS week, event_type AS stream, count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS false_positives, count(*) FILTER (event_id % 3 = 0) >= 150 AS over_budget FROM events GROUP BY 1, 2")
def fre_weekly_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-09, FRE-12."""
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "stream")
    return reconcile.weekly(e, F.col("event_id") % 3 == 0, 150).withColumn("week", F.col("week").cast("bigint"))


# --- quality pipeline


@query(f"WITH {VIEWS['trades']}, s AS (SELECT trade_id, CASE WHEN price > 0 AND quantity > 0 THEN 1.0 ELSE 0.0 END AS schema_score, CASE WHEN ts > TIMESTAMP '2024-01-25' THEN 0.0 ELSE 1.0 END AS leak_score, CASE WHEN price > 60 THEN 0.5 ELSE 1.0 END AS anomaly_score, CASE WHEN age IS NULL THEN 0.9 WHEN age < -5 THEN 0.8 WHEN age <= 86400 THEN 0.95 ELSE 0.9 END AS freshness_score, CASE WHEN trade_id % 10 = 0 THEN 0.8 ELSE 1.0 END AS reconciliation_score FROM (SELECT *, (epoch_us(TIMESTAMP '2024-01-25') - epoch_us(ts)) / 1000000 AS age FROM trades)), f AS (SELECT *, round((0.15 * schema_score + 0.35 * leak_score + 0.2 * anomaly_score + 0.15 * freshness_score + 0.15 * reconciliation_score) / 1.0, 6) AS score FROM s) SELECT trade_id, CAST(score AS DOUBLE) AS score, score >= 0.88 AS passed FROM f")
def qlt_final_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT-01 to QLT-03, QLT-10."""
    now = F.lit("2024-01-25").cast("timestamp_ntz")
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1000000
    stages = {
        "schema": F.when((F.col("price") > 0) & (F.col("quantity") > 0), 1.0).otherwise(0.0), "leakage": F.when(F.col("ts") > now, 0.0).otherwise(1.0), "anomaly": F.when(F.col("price") > 60, 0.5).otherwise(1.0),
        "freshness": reconcile.score(age, "historical"), "reconciliation": F.when(F.col("trade_id") % 10 == 0, 0.8).otherwise(1.0),
    }
    return quality.scored(adapters.trades(spark, sf_dir), stages).select("trade_id", "score", "passed")


@query(" UNION ALL ".join(f"SELECT '{n}' AS analyzer, round(ratio, 6) AS ratio, severity FROM ({ORACLES[f'leak_{n}']})" for n in ("look_ahead", "timing_edge", "execution_edge")))
def leak_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-09: a report of every analyzer that has inputs."""
    found = leakage.combined({n: QUERIES[f"leak_{n}"](spark, sf_dir) for n in ("look_ahead", "timing_edge", "execution_edge")})
    return rounded(found.select("analyzer", "ratio", "severity"))


@query("SELECT event_type AS entity, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-29' AND event_type = 'error'")
def agg_metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-46: an entity's metrics of the last hours, newest first."""
    e = table(spark, sf_dir, "events").where((F.col("ts") > F.lit("2024-01-29").cast("timestamp_ntz")) & (F.col("event_type") == "error"))
    return e.select(F.col("event_type").alias("entity"), "ts", "value").orderBy(F.desc("ts"))
