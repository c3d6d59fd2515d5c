"""Queries on landed rows, ready-made schemas and discrepancy identities, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import landing, leakage, normalize, validate
from ..sources import adapters
from ..sources.adapters import SQL as VIEWS
from ..sources.adapters import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id WHEN 1 THEN user_id WHEN 2 THEN NULL ELSE user_id END AS n, CASE event_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'type_coerced' WHEN 2 THEN 'type_mismatch' ELSE 'type_coerced' END AS state, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag FROM events")
def val_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-03, VAL-06."""
    k, u = F.col("event_id") % 4, F.col("user_id").cast("string")
    text = F.when(k == 0, u).when(k == 1, F.concat(F.lit(" "), u)).when(k == 2, F.concat(u, F.lit("x"))).otherwise(F.concat(F.lit("+"), u))
    flag = F.when(F.col("event_id") % 3 == 0, "Yes").when(F.col("event_id") % 3 == 1, "off").otherwise("maybe")
    e = table(spark, sf_dir, "events").withColumn("r", landing.coerced(text, "bigint"))
    return e.select("event_id", F.col("r.value").alias("n"), F.col("r.state").alias("state"), landing.coerced(flag, "boolean")["value"].alias("flag"))


@query("SELECT event_id AS trade_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE epoch_us(ts) // CASE WHEN event_id % 2 = 0 THEN 1 ELSE 1000 END * CASE WHEN event_id % 2 = 0 THEN 1 ELSE 1000 END END AS ts_us, CASE WHEN event_id % 5 = 0 THEN NULL ELSE round(value, 4)::DOUBLE END AS price, CASE WHEN event_id % 7 = 0 THEN 'no_time' WHEN event_id % 5 = 0 THEN 'bad_price' END AS error FROM events")
def prj_parsed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-01, PRJ-02."""
    i, us = F.col("event_id"), F.unix_micros(F.col("ts").cast("timestamp"))
    raw = table(spark, sf_dir, "events").select(
        i.alias("trade_id"), F.when((i % 7 != 0) & (i % 2 == 0), us.cast("string")).alias("timestamp_utc_us"), F.when((i % 7 != 0) & (i % 2 == 1), F.call_function("div", us, F.lit(1000).cast("bigint")).cast("string")).alias("timestamp"),
        F.when(i % 5 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("price"), F.lit("1").alias("quantity"),
    )
    return landing.parsed_trades(raw).select("trade_id", "ts_us", F.col("price").cast("double").alias("price"), "error")


@query("SELECT event_id, event_type AS kind, round(value * 2, 6) AS amount, CASE WHEN event_id % 3 = 0 THEN 'k' WHEN event_id % 3 = 1 THEN 'extra,k' ELSE 'k,other' END AS unexpected FROM events")
def prj_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-26, VAL-02."""
    e = table(spark, sf_dir, "events").withColumn("line", F.concat(F.when(F.col("event_id") % 3 == 0, '{"known": 2, ').when(F.col("event_id") % 3 == 1, '{"extra": 1, "known": 2, ').otherwise('{"known": 2, "other": 3, '), F.expr("substr(props, 2)")))
    out = landing.renamed(e, {"event_type": "kind", "value": "amount"}, {"amount": lambda c: F.round(c * 2, 6)})
    return out.select("event_id", "kind", "amount", F.array_join(landing.unexpected(F.col("line"), ["known"]), ",").alias("unexpected"))


@query(
    f"""WITH {VIEWS['trades']}, v AS (SELECT trade_id, unnest([CASE WHEN venue IS NULL THEN 'missing:venue' END, CASE WHEN symbol IS NULL THEN 'missing:symbol' END, CASE WHEN price IS NULL THEN 'missing:price' END, CASE WHEN price < 1e-12 THEN 'below_minimum:price' END, CASE WHEN price > 1e7 THEN 'above_maximum:price' END,
 CASE WHEN quantity IS NULL THEN 'missing:quantity' END, CASE WHEN quantity < 1e-12 THEN 'below_minimum:quantity' END, CASE WHEN lower(side) NOT IN ('buy', 'sell') THEN 'not_allowed:side' END, CASE WHEN trade_id IS NULL THEN 'key_missing:trade_id' END, CASE WHEN abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) > 7 * 86400000000 THEN 'implausible_time:ts' END]) AS broken FROM trades)
SELECT split_part(broken, ':', 1) AS kind, count(*) AS violations, min(trade_id) AS first_row FROM v WHERE broken IS NOT NULL GROUP BY broken"""
)
def val_trade_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-30, VAL-31, VAL-35."""
    v = validate.violations(adapters.trades(spark, sf_dir), landing.trade_schema(F.lit("2024-01-15").cast("timestamp"), 7 * 24))
    return validate.summary(v, "trade_id").drop("field")


@query(f"WITH {VIEWS['options']} SELECT 'below_minimum' AS kind, 'gamma' AS field, count(*) AS violations, min(symbol) AS first_row FROM options WHERE gamma < 0 HAVING count(*) > 0")
def val_option_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-32."""
    return validate.summary(validate.violations(adapters.options(spark, sf_dir), landing.option_schema()), "symbol")


@query("WITH f AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN '0xZZ' ELSE '0x' || left(md5(CAST(o_custkey AS VARCHAR)), 32) || '00000000' END AS a, o_orderkey AS block, o_totalprice AS amount FROM orders) SELECT 'pattern_mismatch' AS kind, 'from_address' AS field, count(*) AS violations, min(id) AS first_row FROM f WHERE a = '0xZZ' UNION ALL SELECT 'above_maximum', 'block_number', count(*), min(id) FROM f WHERE block > 1100")
def val_flow_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-33."""
    address = F.concat(F.lit("0x"), F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 32), F.lit("00000000"))
    f = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("x").alias("chain"), F.when(F.col("o_orderkey") % 9 == 0, "0xZZ").otherwise(address).alias("from_address"), address.alias("to_address"), F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("tx_hash"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("block_number"),
    )
    return validate.summary(validate.violations(f, landing.flow_schema(1000)), "id")


@query("WITH v AS (SELECT 'too_early' AS kind, 'start' AS field, o_orderkey AS id FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' UNION ALL SELECT 'wrong_order', 'end', o_orderkey FROM orders WHERE o_orderkey % 8 = 0 UNION ALL SELECT 'weekend', 'start', o_orderkey FROM orders WHERE isodow(o_orderdate) >= 6 UNION ALL SELECT 'repeated_time', 'times', o_orderkey FROM orders WHERE o_orderkey % 6 = 1 AND o_orderkey % 8 <> 0 UNION ALL SELECT 'future', 'times', o_orderkey FROM orders WHERE greatest(o_orderdate, o_orderdate + CASE WHEN o_orderkey % 8 = 0 THEN INTERVAL (-1) DAY WHEN o_orderkey % 6 = 1 THEN INTERVAL 0 DAY ELSE INTERVAL 1 DAY END) > TIMESTAMP '2000-01-01 00:05:00') SELECT kind, field, count(*) AS violations, min(id) AS first_row FROM v GROUP BY 1, 2")
def val_calendar_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-22, VAL-23, VAL-26, VAL-34."""
    shift = F.when(F.col("o_orderkey") % 8 == 0, F.expr("INTERVAL -1 DAY")).when(F.col("o_orderkey") % 6 == 1, F.expr("INTERVAL 0 DAY")).otherwise(F.expr("INTERVAL 1 DAY"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + shift).alias("end"), F.lit("a long title").alias("title"), F.lit("event-0001").alias("event_id"))
    base = landing.calendar_schema("2002-01-01")
    schema = validate.Schema(base.name, base.fields, (), (*base.rules, landing.weekend("start", "start"), *landing.times_rules("times", ["start", "end"], F.lit("2000-01-01").cast("timestamp"))))
    return validate.summary(validate.violations(o, schema), "id")


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'security' WHEN 'view' THEN 'governance_proposal' WHEN 'click' THEN 'release' ELSE 'other' END AS kind, CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 4 ELSE 5 END AS priority, CASE WHEN event_id % 2 = 0 THEN 'Leakage' ELSE 'Custom' END AS incident_class FROM events")
def prj_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-16, PRJ-17, PRJ-29."""
    raw = F.when(F.col("event_type") == "error", "Bridge Exploit").when(F.col("event_type") == "view", "x").when(F.col("event_type") == "click", "Release 1.2").otherwise("news")
    kind = normalize.event_type(raw, F.when(F.col("event_type") == "view", "Snapshot").otherwise("web"))
    e = table(spark, sf_dir, "events").withColumn("kind", kind)
    topic = F.when(F.col("event_id") % 2 == 0, "incidents.leakage").otherwise("incidents.misc")
    return e.select("event_id", "kind", normalize.event_priority(F.col("kind")).alias("priority"), normalize.incident_class(topic, F.lit("Custom")).alias("incident_class"))


@query("SELECT o_orderkey AS k, left(sha256('lines|orders|' || CAST(o_orderkey AS VARCHAR)), 16) AS discrepancy_id, 'leak_' || left(sha256('look_ahead|' || o_orderstatus), 12) AS incident_id FROM orders JOIN (SELECT l_orderkey AS k, min(l_shipdate) AS s FROM lineitem GROUP BY 1) ON k = o_orderkey WHERE epoch_us(s) - epoch_us(o_orderdate) > 864000000000")
def rec_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-07, REC-10, LEAK-10: rows that arrived more than ten days late, with their identities."""
    ship = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("arrival"))
    j = landing.aligned(table(spark, sf_dir, "orders"), ship, "o_orderkey")
    late = landing.delayed(j, "arrival", "o_orderdate", 5 * 2880)
    return late.select(F.col("o_orderkey").alias("k"), landing.symmetric_id("orders", "lines", F.col("o_orderkey")).alias("discrepancy_id"), leakage.incident_id(F.lit("look_ahead"), F.col("o_orderstatus")).alias("incident_id"))
