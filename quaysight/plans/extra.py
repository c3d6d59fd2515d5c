"""Queries on semantic checks, further identities, alarms, spines, the batch detector and stream forms, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashes
from ..operators import anomaly, bars, events, features, incidents, market, reconcile, validate
from ..sources import adapters, io
from ..sources.adapters import SQL as VIEWS
from ..sources.adapters import table
from ..streaming import bars as st
from .market import bars_sql, rounded

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_CONTACT = {
    "email": "CASE WHEN c_custkey % 3 = 0 THEN replace(c_name, '#', ' ') ELSE replace(c_name, '#', '.') END || '@mail' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '.example' END",
    "url": "CASE WHEN c_custkey % 5 = 0 THEN 'ftp' ELSE 'https' END || '://host' || CASE WHEN c_custkey % 6 = 0 THEN ' ' ELSE '/' END || replace(c_name, '#', '')",
    "phone": "'(+' || CAST(c_custkey % 10 AS VARCHAR(9)) || ') ' || c_phone",
    "country_code": "CASE WHEN c_custkey % 2 = 0 THEN substr(c_mktsegment, 1, 2) ELSE lower(substr(c_mktsegment, 1, 2)) END",
    "currency_code": "substr(c_mktsegment, 1, CAST(2 + c_custkey % 3 AS INT))",
}
_LOOKS = {"email": "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$", "url": "^https?://[^ /$.?#].[^ ]*$", "phone": "^[+]?[1-9][0-9]{1,14}$", "country_code": "^[A-Z]{2}$", "currency_code": "^[A-Z]{3}$"}


def _contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("c_phone", F.lpad((F.col("c_custkey") * 7919).cast("string"), 10, "0"))
    return c.select("c_custkey", *[F.expr(e.replace("VARCHAR(9)", "STRING")).alias(k) for k, e in _CONTACT.items()])


@query(
    "SELECT c_custkey, " + ", ".join(f"CAST(regexp_matches({f"regexp_replace({e}, '[^0-9+]', '', 'g')" if k == 'phone' else e}, '{_LOOKS[k]}') AS INT) AS {k}" for k, e in _CONTACT.items()) + " FROM (SELECT * REPLACE (lpad(CAST(c_custkey * 7919 AS VARCHAR), 10, '0') AS c_phone) FROM (SELECT c_custkey, c_name, c_mktsegment, '' AS c_phone FROM customer))"
)
def val_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-15: 1 where a text is what it should be."""
    schema = validate.Schema("contacts", tuple(validate.Field(k, semantic=k) for k in _CONTACT))
    v = validate.violations(_contacts(spark, sf_dir), schema)
    return v.select("c_custkey", *[(~F.array_contains("violations.field", k)).cast("int").alias(k) for k in _CONTACT])


@query("SELECT event_id, event_id % 4 = 0 AS bad_item, event_id % 5 = 0 AS bad_value, event_type = 'click' AS bad_key FROM events")
def val_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-10, VAL-11: types of array items and map values, and map keys."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    items = F.array(i.cast("string"), F.when(i % 4 == 0, "n/a").otherwise(F.col("user_id").cast("string")), F.lit(None).cast("string"))
    e = e.select("event_id", items.alias("items"), F.create_map(F.col("event_type"), F.when(i % 5 == 0, "much").otherwise(F.col("value").cast("string"))).alias("sizes"))
    v = validate.violations(e, validate.Schema("lists", (validate.Field("items", item_kind="bigint"), validate.Field("sizes", value_kind="double", key_pattern="(?!click).*"))))
    has = lambda kind: F.exists("violations", lambda x: x["kind"] == kind)
    return v.select("event_id", has("item_mismatch").alias("bad_item"), has("value_mismatch").alias("bad_value"), has("key_mismatch").alias("bad_key"))


@query(f"WITH {VIEWS['options']}, h AS (SELECT sha256(symbol || ':' || CAST(expiry AS VARCHAR) || ':' || CAST(CAST(strike AS BIGINT) AS VARCHAR) || ':' || option_type) AS identity, symbol || ':' || CAST(expiry AS VARCHAR) || ':' || CAST(CAST(strike AS BIGINT) AS VARCHAR) || ':' || option_type || ':iv=' || CAST(CAST(iv AS DECIMAL(10, 4)) AS VARCHAR) || CASE WHEN delta > 0.3 THEN '' ELSE ':delta=' || CAST(CAST(delta AS DECIMAL(10, 4)) AS VARCHAR) END AS c FROM options) SELECT identity, count(*) AS quotes, count(DISTINCT c) AS versions, min(sha256(c)) AS first_content FROM h GROUP BY 1")
def prj_option_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-20: quotes and versions of each contract."""
    o = adapters.options(spark, sf_dir)
    key = [F.col("symbol"), F.col("expiry"), F.col("strike").cast("bigint"), F.col("option_type")]
    o = o.select(hashes.joined_hash(*key).alias("identity"), hashes.content_hash(key, iv=F.col("iv").cast("decimal(10,4)"), delta=F.when(F.col("delta") <= 0.3, F.col("delta").cast("decimal(10,4)"))).alias("content"))
    return o.groupBy("identity").agg(F.count("*").alias("quotes"), F.count_distinct("content").alias("versions"), F.min("content").alias("first_content"))


@query(f"WITH {VIEWS['flows']} SELECT flow_id, sha256(chain || ':' || event_type || ':tx' || CAST(flow_id // 3 AS VARCHAR) || ':' || CASE WHEN flow_id % 3 = 0 THEN CAST(flow_id % 7 AS VARCHAR) ELSE lower(from_address) || ':' || lower(to_address) || ':usdc:' || CASE WHEN flow_id % 3 = 1 THEN CAST(CAST(round_even(value_usd, 1) AS DECIMAL(38, 1)) AS VARCHAR) ELSE CAST(CAST(value_usd AS DECIMAL(38, 18)) AS VARCHAR) END END) AS identity FROM (SELECT * REPLACE (CAST(value_usd AS DECIMAL(18, 2)) AS value_usd) FROM flows)")
def prj_flow_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-21: by index, by an amount of one decimal, and by one of 18."""
    f, i = adapters.flows(spark, sf_dir), F.col("flow_id")
    tx = F.concat(F.lit("tx"), F.floor(i / 3).cast("string"))
    return f.select("flow_id", hashes.flow_hash(F.col("chain"), F.col("event_type"), tx, F.when(i % 3 == 0, i % 7), (F.col("from_address"), F.col("to_address")), F.lit("USDC"), F.col("value_usd").cast("decimal(18,2)"), F.when(i % 3 == 1, 1)).alias("identity"))


@query("SELECT identity, count(*) AS n, min(event_id) AS first_event FROM (SELECT event_id, sha256(event_type || ':' || CAST(epoch_us(ts) // 300000000 * 300000000 AS VARCHAR) || ':' || CAST(CAST(round_even(value, 0) AS BIGINT) AS VARCHAR)) AS identity FROM events) GROUP BY 1")
def prj_metric_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-22."""
    e = table(spark, sf_dir, "events").select("event_id", hashes.window_hash(F.col("event_type"), F.unix_micros(F.col("ts").cast("timestamp")), F.col("value")).alias("identity"))
    return e.groupBy("identity").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query(
    f"""WITH {VIEWS['levels']}, b AS (SELECT symbol, list_sort(list(price) FILTER (bid)) AS bids, list_sort(list(price) FILTER (NOT bid)) AS asks FROM levels GROUP BY 1)
SELECT symbol, CASE WHEN symbol % 2 = 0 THEN len(list_distinct(bids[1:10])) > 1 ELSE false END AS bids_unordered, CASE WHEN symbol % 2 = 1 THEN len(list_distinct(list_reverse(asks)[1:10])) > 1 ELSE false END AS asks_unordered, coalesce(bids[len(bids)] > asks[1], false) AS crossed FROM (SELECT symbol, coalesce(bids, []) AS bids, coalesce(asks, []) AS asks FROM b)"""
)
def val_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-28, VAL-29: books of even symbols have rising, of odd ones falling prices on both sides."""
    b = adapters.book_levels(spark, sf_dir)
    up = F.col("symbol") % 2 == 0
    b = b.withColumns({s: F.when(up, F.sort_array(s)).otherwise(F.sort_array(s, asc=False)) for s in ("bids", "asks")})
    return market.book_order_violations(b).select("symbol", "bids_unordered", "asks_unordered", "crossed")


_ALARM = "value / 20 AS ratio, user_id % 30 AS n, (event_id % 10) / 10 AS cv, (event_id % 7) / 10 AS fp, (event_id % 5) / 100 AS weekly"


@query(
    f"""WITH a AS (SELECT event_id, {_ALARM} FROM events), c AS (SELECT *, greatest(0.1, least(1.0, CASE WHEN ratio < 1.5 THEN 0.6 WHEN ratio > 3 THEN 1.1 ELSE 1 END * CASE WHEN n < 5 THEN 0.7 WHEN n > 20 THEN 1.05 ELSE 1 END * CASE WHEN n >= 3 AND cv < 0.1 THEN 1.1 WHEN n >= 3 AND cv > 0.5 THEN 0.8 ELSE 1 END * CASE WHEN fp > 0.1 THEN 1 - least(0.3, fp) ELSE 1 END * CASE WHEN weekly >= 0.024 THEN 0.7 ELSE 1 END)) AS confidence FROM a)
SELECT event_id, round(CAST(confidence AS DOUBLE), 6) AS confidence, ratio > 4 OR weekly < 0.03 OR confidence > 0.9 AS opened FROM c"""
)
def fre_alarm_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-07, FRE-12."""
    a = table(spark, sf_dir, "events").selectExpr("event_id", *(x.strip() for x in _ALARM.split(",")))
    a = a.withColumn("confidence", reconcile.alarm_confidence(F.col("ratio"), F.col("n"), F.col("cv"), F.col("fp"), F.col("weekly"), 0.03))
    return rounded(a.select("event_id", "confidence", reconcile.alarm_gate(reconcile.level(F.col("ratio"), F.lit(1.0)), F.col("confidence"), F.col("weekly"), 0.03).alias("opened")))


@query(f"WITH {VIEWS['trades']}, {bars_sql({'5m': 300}, 'symbol')}, p AS (SELECT symbol, bar_start, close, lag(close, 1) OVER w AS p1, lag(close, 3) OVER w AS p3 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_start)) SELECT symbol, bar_start, round(CASE WHEN p1 > 0 THEN (close / p1 - 1) * 100 ELSE 0 END, 6) + 0.0 AS momentum_5m, round(CASE WHEN p3 > 0 THEN (close / p3 - 1) * 100 ELSE 0 END, 6) + 0.0 AS momentum_15m FROM p")
def win_short_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-13 at five and fifteen minutes."""
    return rounded(features.short_momentum(bars.bars(adapters.trades(spark, sf_dir), ["5m"], ["symbol"])))


@query(f"WITH {VIEWS['incidents']} SELECT incident_class, severity, count(*) AS n, count(*) FILTER (resolved) AS resolved, round(avg(CASE WHEN resolved THEN (1 + incident_id % 7) * 3600.0 END), 6) AS mean_resolution_s FROM incidents GROUP BY 1, 2")
def agg_incident_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-32."""
    i = adapters.incidents(spark, sf_dir).withColumn("resolved_at", F.expr("CASE WHEN resolved THEN ts + make_dt_interval(0, CAST(1 + incident_id % 7 AS INT)) END"))
    return rounded(incidents.resolution(i, "resolved_at"))


@query("SELECT event_id, coalesce(user_id * 3600.0, 1e18) > 259200 AS rates_stale, greatest(value * 100, CASE WHEN event_id % 3 = 0 THEN 1e18 ELSE 0 END) > 3600 AS equities_stale, concat_ws(',', CASE WHEN event_id % 3 = 0 THEN 'spx' END, CASE WHEN event_id % 4 = 0 THEN 'vix' END) AS missing FROM events")
def agg_macro_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-19: what is stale or missing in a snapshot."""
    i = F.col("event_id")
    s = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") * 3600.0).alias("ust_age_s"), (F.col("value") * 100).alias("ndx_age_s"), F.when(i % 3 != 0, 0.0).alias("spx_age_s"), F.when(i % 3 != 0, 1.0).alias("spx"), F.when(i % 4 != 0, 1.0).alias("vix"))
    return events.snapshot_flags(s, ["ust"], ["ndx", "spx"], ["spx", "vix"]).select("event_id", "rates_stale", "equities_stale", F.array_join("missing", ",").alias("missing"))


@query(f"WITH {VIEWS['flows']}, m AS (SELECT unnest(generate_series((SELECT date_trunc('month', min(ts)) FROM flows), (SELECT date_trunc('month', max(ts)) FROM flows) + INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS bucket), c AS (SELECT DISTINCT chain FROM flows UNION ALL SELECT 'quiet'), n AS (SELECT chain, date_trunc('month', ts) AS bucket, count(*) AS tx, sum(greatest(value_usd, 0)) AS usd FROM flows GROUP BY 1, 2) SELECT c.chain, m.bucket::TIMESTAMP AS bucket, coalesce(n.tx, 0) AS tx_count, round(coalesce(n.usd / n.tx, 0), 3) AS mean_usd FROM m CROSS JOIN c LEFT JOIN n ON n.chain = c.chain AND n.bucket = m.bucket")
def agg_flow_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-25: chains and months without flows have rows of zeros."""
    f = adapters.flows(spark, sf_dir)
    wallets = f.select("chain").distinct().withColumn("address", F.lit("wallet1"))
    bounds = f.agg(F.date_trunc("month", F.min("ts")).alias("a"), F.max("ts").alias("b"))
    months = bounds.select(F.explode(F.sequence(F.col("a").cast("date"), F.add_months(F.trunc("b", "month"), 2), F.expr("INTERVAL 1 MONTH"))).alias("d")).select(F.col("d").cast("timestamp_ntz").alias("bucket"))
    spine = months.withColumn("chain", F.explode(F.array(*[F.lit(f"chain{k}") for k in range(5)], F.lit("quiet")))).select("chain", "bucket")
    found = market.flow_features(f, wallets, "month").withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))
    return rounded(market.on_spine(found, spine, ["chain", "bucket"]).select("chain", "bucket", "tx_count", "mean_usd"), 3)


@query(
    """WITH v AS (SELECT event_id AS id, ts, 'value' AS field, CASE WHEN event_id % 101 = 0 THEN 'nan'::DOUBLE ELSE value END AS x FROM events UNION ALL SELECT event_id, ts, 'user_id', CAST(user_id AS DOUBLE) FROM events), g AS (SELECT * FROM v WHERE NOT isnan(x)),
s AS (SELECT *, count(x) OVER w AS n, avg(x) OVER w AS m, stddev_samp(x) OVER w AS sd FROM g WINDOW w AS (PARTITION BY field ORDER BY ts, id ROWS BETWEEN 549 PRECEDING AND CURRENT ROW)),
j AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000 AS gap, abs(x - lag(x) OVER w) AS jump FROM g WINDOW w AS (PARTITION BY field ORDER BY ts, id)),
r AS (SELECT event_id AS id, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000 AS since FROM events WINDOW w AS (PARTITION BY event_type, user_id % 50 ORDER BY ts, event_id)), p AS (SELECT event_id AS id, (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts, event_id))) / 1000000 AS gap FROM events)
SELECT 'spike' AS kind, field, id, round(abs(x - m) / sd, 6) AS measure, CAST(n AS DOUBLE) AS n, round(m, 6) AS mean FROM s WHERE n >= 100 AND sd > 0 AND abs(x - m) / sd > 3 UNION ALL SELECT 'jump', field, id, round(jump, 6), NULL, NULL FROM j WHERE gap >= 60 AND jump / gap > 0.5
UNION ALL SELECT 'non_finite', field, id, NULL, NULL, NULL FROM v WHERE isnan(x) UNION ALL SELECT 'repeated_row', NULL, id, since, NULL, NULL FROM r WHERE since <= 300 UNION ALL SELECT 'gap', NULL, id, gap, NULL, NULL FROM p WHERE gap > 900"""
)
def ano_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-16, ANO-17: all checks on the events; flat runs of ten equal values don't occur."""
    e = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 101 == 0, float("nan")).otherwise(F.col("value")))
    found = anomaly.analysed(e, "events", "event_id", "ts", ["value", "user_id"], hashes.joined_hash(F.col("event_type"), F.col("user_id") % 50))
    return rounded(found.where("kind != 'flatline'").select("kind", "field", "id", F.when(F.col("kind") != "non_finite", F.col("measure")).alias("measure"), F.col("evidence")["n"].alias("n"), F.col("evidence")["mean"].alias("mean")))


@query(f"WITH {VIEWS['flows']}, b AS (SELECT flow_id, chain, flow_id // 100 AS block FROM flows) SELECT chain, flow_id AS id, block FROM b WHERE block <= (SELECT max(block) FROM b x WHERE x.chain = b.chain) - 12")
def str_finality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-09: flows twelve blocks below the tip, in several micro-batches."""
    path = io.scratch(spark, "flows")
    f = adapters.flows(spark, sf_dir).select("chain", F.col("flow_id").alias("id"), F.floor(F.col("flow_id") / 100).alias("block"))
    f.repartitionByRange(4, "block").write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    return st.drained(st.finality(stream, 12))


@query("SELECT event_type, count(*) AS alerts, max(value) AS worst FROM events WHERE value > 60 GROUP BY 1")
def str_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-06, STR-10: a callback per micro-batch, which here writes what it is told."""
    path = io.scratch(spark, "alerts")
    events_ = st.file_stream(spark, f"{sf_dir}/events.parquet", "ts").where("value > 60").select("event_type", "value")
    spark.createDataFrame([], events_.schema).write.parquet(f"{path}/batch=none")
    st.alerted(events_, io.idempotent_sink(path))
    told = spark.read.schema(events_.schema).option("recursiveFileLookup", "true").parquet(path)
    return told.groupBy("event_type").agg(F.count("*").alias("alerts"), F.max("value").alias("worst"))
