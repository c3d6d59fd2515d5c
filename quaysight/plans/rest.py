"""Queries that make the remaining rules, normalisers and reports fire, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashes
from ..operators import landing, leakage, normalize, quality, reconcile, validate
from ..sources import adapters, io, ledger
from ..sources.adapters import SQL as VIEWS
from ..sources.adapters import table
from .market import rounded
from .timed import landed

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(
    """WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 > 0 THEN o_orderstatus END AS status, o_orderpriority AS priority, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS ts, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey END AS key, o_custkey AS c FROM orders),
v AS (SELECT 'missing' AS kind, 'status' AS field, k FROM t WHERE status IS NULL UNION ALL SELECT 'too_short', 'priority', k FROM t WHERE length(priority) < 6 UNION ALL SELECT 'too_long', 'priority', k FROM t WHERE length(priority) > 8 UNION ALL SELECT 'custom', 'c', k FROM t WHERE c % 2 = 1 UNION ALL SELECT 'item_below_minimum', 'items', k FROM t WHERE k % 4 = 0
UNION ALL SELECT 'conditional_missing', 'filled', k FROM t WHERE status = 'F' AND (price IS NULL OR ts IS NULL) UNION ALL SELECT 'not_exclusive', 'one_of', k FROM t WHERE (price IS NULL) = (ts IS NULL) UNION ALL SELECT 'key_missing', 'key', k FROM t WHERE key IS NULL)
SELECT kind, field, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys FROM v GROUP BY ALL"""
)
def val_every_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-01, VAL-07, VAL-10, VAL-16 with UDF-01, VAL-17, VAL-18: rules that fire."""
    k = F.col("o_orderkey")
    unless = lambda n, c: F.when(k % n > 0, F.col(c))
    t = table(spark, sf_dir, "orders").select(
        k.alias("k"), unless(7, "o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), unless(5, "o_totalprice").alias("price"), unless(3, "o_orderdate").alias("ts"), unless(11, "o_orderkey").alias("key"), F.col("o_custkey").alias("c"),
        F.array(F.lit(3), F.when(k % 4 == 0, 1).otherwise(2)).alias("items"),
    )
    fields = (validate.Field("status", required=True), validate.Field("priority", min_length=6, max_length=8), validate.Field("c", custom=lambda x: x % 2 == 0), validate.Field("items", item_low=2))
    rules = (validate.conditional("filled", lambda: F.col("status") == "F", ["price", "ts"]), validate.exclusive("one_of", ["price", "ts"]))
    v = validate.violations(t, validate.Schema("orders", fields, ("key",), rules)).select("k", F.explode("violations").alias("v"))
    return v.groupBy("v.kind", "v.field").agg(F.count("*").alias("n"), F.sum("k").cast("long").alias("keys"))


_BANDS = {"validator": ("10000000000", "10000000000000", "10000000000000000", None), "reconciler": ("100000000000", "100000000000000", "100000000000000000", None)}


def _band_sql(name: str) -> str:
    s, ms, us, _ = _BANDS[name]
    return f"CASE WHEN x < {s} THEN x * 1000000 WHEN x < {ms} THEN x * 1000 WHEN x < {us} THEN x ELSE x // 1000 END"


@query(
    f"""WITH t AS (SELECT event_id, ts, CAST((event_id % 1000 + 1) * 10 ** (event_id % 16) AS BIGINT) AS x FROM events)
SELECT event_id, {_band_sql("validator")} AS validator_us, {_band_sql("reconciler")} AS reconciler_us, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN epoch_us(date_trunc('day', ts)) WHEN 1 THEN epoch_us(date_trunc('second', ts)) WHEN 2 THEN epoch_us(date_trunc('second', ts)) - 7200000000 ELSE epoch_us(ts) END AS text_us FROM t"""
)
def prj_epoch_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-05, PRJ-06: epochs of all sizes by the bands of both, and times as texts of several forms, one of which is none."""
    i, ts = F.col("event_id"), F.col("ts")
    x = (F.pow(F.lit(10.0), i % 16) * (i % 1000 + 1)).cast("long")
    text = F.when(i % 5 == 4, "soon").when(i % 5 == 3, F.date_format(ts, "yyyy-MM-dd")).when(i % 5 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(i % 5 == 2, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    e = table(spark, sf_dir, "events")
    return e.select("event_id", normalize.epoch_us(x, "validator").alias("validator_us"), normalize.epoch_us(x, "reconciler").alias("reconciler_us"), normalize.text_us(text).alias("text_us"))


@query(
    """WITH l AS (SELECT l_orderkey AS book, l_linenumber AS i, CAST(l_partkey % 900 AS BIGINT) AS p, CAST(l_quantity AS BIGINT) - 5 AS q FROM lineitem), g AS (SELECT book, i, p, q, row_number() OVER (PARTITION BY book ORDER BY i, p, q) AS r FROM l WHERE p > 0 AND q > 0 AND i % 2 = 1), h AS (SELECT book, i, p, q, row_number() OVER (PARTITION BY book ORDER BY i, p, q) AS r FROM l WHERE p > 0 AND q > 0 AND i % 2 = 0),
b AS (SELECT book, string_agg(p || '.0@' || q || '.0', ',' ORDER BY r) FILTER (r <= 5) AS s, count(*) AS n FROM g GROUP BY 1), a AS (SELECT book, string_agg(p || '.0@' || q || '.0', ',' ORDER BY r) FILTER (r <= 5) AS s, count(*) AS n FROM h GROUP BY 1)
SELECT k.book, coalesce(b.n, 0) AS n_bids, coalesce(a.n, 0) AS n_asks, sha256(k.book || ':' || coalesce(b.s, '') || ':' || coalesce(a.s, '')) AS hash FROM (SELECT DISTINCT book FROM l) k LEFT JOIN b ON b.book = k.book LEFT JOIN a ON a.book = k.book"""
)
def prj_book_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-03, PRJ-23: levels as pairs of texts and as maps, of which some have no price or quantity, and the hash of the first five."""
    p, q, i = (F.col("l_partkey") % 900).cast("long"), F.col("l_quantity").cast("long") - 5, F.col("l_linenumber")
    # Of lines of one number the order is that of their numbers too.
    one = F.struct(i.alias("i"), p.alias("p"), q.alias("q"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("book")).agg(F.array_sort(F.collect_list(F.when(i % 2 == 1, one))).alias("b"), F.array_sort(F.collect_list(F.when(i % 2 == 0, one))).alias("a"))
    pairs = F.transform("b", lambda x: F.array(x["p"].cast("string"), x["q"].cast("string")))
    maps = F.transform("a", lambda x: F.create_map(F.lit("price"), x["p"], F.lit("quantity"), x["q"]))
    b = b.select("book", normalize.level_pairs(pairs).alias("bids"), normalize.level_maps(maps).alias("asks"))
    return b.select("book", F.size("bids").cast("long").alias("n_bids"), F.size("asks").cast("long").alias("n_asks"), hashes.levels_hash(F.col("book"), F.col("bids"), F.col("asks")).alias("hash"))


@query(
    """SELECT o_orderkey, round(CAST(100 - a - b AS DOUBLE), 6) AS alt_dominance, round(CASE WHEN cap > 0 THEN o_totalprice / cap ELSE 0 END, 6) AS volume_ratio, (epoch_us(TIMESTAMP '2002-01-01') - epoch_us(o_orderdate)) / 1e6 AS age_s, round((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1996-01-01')) / 86400e6, 6) AS days
FROM (SELECT *, o_orderkey % 60 + 0.5 AS a, o_custkey % 30 + 0.25 AS b, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey * 1000.0 END AS cap FROM orders)"""
)
def prj_market_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-12, PRJ-13: dominances, volume by market capitalisation, the age of the data and days to expiry."""
    o = table(spark, sf_dir, "orders").withColumns({"btc_dominance": F.col("o_orderkey") % 60 + 0.5, "eth_dominance": F.col("o_custkey") % 30 + 0.25, "market_cap": F.when(F.col("o_orderkey") % 9 == 0, 0.0).otherwise(F.col("o_custkey") * 1000.0), "volume": F.col("o_totalprice"), "ts": F.col("o_orderdate")})
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    found = normalize.market_structure(o, at("2002-01-01"))
    return rounded(found.select("o_orderkey", "alt_dominance", "volume_ratio", "age_s", normalize.days_to_expiry(F.col("o_orderdate"), at("1996-01-01")).alias("days")), 6)


_STAGE = {"schema": "1 - (event_id % 7) / 300.0", "leakage": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 1 - (event_id % 3) / 25.0 END", "anomaly": "1 - (event_id % 11) / 40.0"}
_GATE = {"schema": 0.99, "leakage": 1.0, "anomaly": 0.90}


def _result_sql(stage: str) -> str:
    g = _GATE[stage]
    return f"CASE WHEN {stage} IS NULL THEN 'error' WHEN {stage} >= {g} THEN 'pass' WHEN {stage} >= {g} * 0.9 THEN 'warn' ELSE 'fail' END"


@query(
    f"""WITH s AS (SELECT {", ".join(f"({e})::DOUBLE AS {k}" for k, e in _STAGE.items())} FROM events), r AS (SELECT {", ".join(f"{_result_sql(k)} AS {k}" for k in _STAGE)} FROM s),
m AS (SELECT unnest([{{'mode': 'strict', 'ok': ['pass']}}, {{'mode': 'resilient', 'ok': ['pass', 'warn']}}, {{'mode': 'degraded', 'ok': ['pass', 'warn', 'fail']}}, {{'mode': 'emergency', 'ok': ['pass', 'warn', 'fail', 'error']}}]) AS m)
SELECT m.mode AS mode, CASE {" ".join(f"WHEN NOT list_contains(m.ok, {k}) THEN '{k}'" for k in _STAGE)} ELSE 'none' END AS stopped_at, count(*) AS n FROM r CROSS JOIN m GROUP BY ALL"""
)
def qlt_stopped_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QLT-01: the stage that stops a message, in each of the four modes."""
    s = quality.scored(table(spark, sf_dir, "events"), {k: F.expr(e).cast("double") for k, e in _STAGE.items()})
    out = None
    for mode in quality.MODES:
        one = quality.reached(s, list(_STAGE), mode).groupBy(F.coalesce("stopped_at", F.lit("none")).alias("stopped_at")).agg(F.count("*").alias("n")).withColumn("mode", F.lit(mode))
        out = one if out is None else out.unionByName(one)
    return out.select("mode", "stopped_at", "n")


@query(
    """WITH c AS (SELECT 'p_name' AS "column", 'string' AS type_a, 'int' AS type_b, count(p_name) AS n_a, count(CASE WHEN p_size > 25 THEN 1 END) AS n_b FROM part UNION ALL SELECT 'p_retailprice', 'double', '', count(p_retailprice), 0 FROM part UNION ALL SELECT 'extra', '', 'boolean', 0, count(*) FROM part) SELECT * FROM c"""
)
def rec_schema_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-03: columns of two sources that differ in type, and how many values each has."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    b = p.select("p_partkey", F.when(F.col("p_size") > 25, 1).alias("p_name"), "p_size", F.lit(True).alias("extra"))
    found = landing.schema_difference(p, b)
    count = lambda df, side: df.select(*[F.count(c).alias(c) for c, *_ in found if c in df.columns]).select(F.explode(F.create_map(*[x for c, *_ in found if c in df.columns for x in (F.lit(c), F.col(c))])).alias("column", side))
    kinds = spark.createDataFrame(found, "column string, type_a string, type_b string")
    return kinds.join(count(p, "n_a"), "column", "left").join(count(b, "n_b"), "column", "left").na.fill(0, ["n_a", "n_b"])


@query(
    """SELECT "column", n, suspicious FROM (SELECT 'value' AS "column", count(value) AS n, false AS suspicious FROM events UNION ALL SELECT 'target_price', count(*), true FROM events UNION ALL SELECT 'event_type', count(event_type), false FROM events UNION ALL SELECT 'trade_result', count(*) FILTER (event_id % 2 = 0), true FROM events)"""
)
def val_analysed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-38, VAL-40: the columns worth an analysis, their values, and whether their names speak of the answer."""
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", (F.col("value") * 2).alias("target_price"), F.when(i % 2 == 0, "won").alias("trade_result"), F.md5("event_type").alias("row_hash"), F.col("ts").alias("ts"))
    chosen = landing.analysed(e, exclude=("ts",))
    odd = leakage.suspicious_columns(e)
    counts = e.select(*[F.count(c).alias(c) for c in chosen])
    return counts.select(F.explode(F.create_map(*[x for c in chosen for x in (F.lit(c), F.col(c))])).alias("column", "n")).withColumn("suspicious", F.col("column").isin(odd))


@query(
    """WITH g AS (SELECT event_type, event_id, row_number() OVER o AS k, (epoch_us(ts) - epoch_us(lag(ts) OVER o)) / 1e6 AS gap_s FROM events WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id)), l AS (SELECT *, list_sort(list_filter(list(gap_s) OVER (PARTITION BY event_type ORDER BY k ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL)) AS s FROM g)
SELECT event_type, event_id, round(gap_s, 6) AS gap_s, round(s[1 + least(CAST(floor(len(s) * 0.95) AS INT), len(s) - 1)], 6) AS p_gap_s FROM l"""
)
def fre_interval_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-01: the 95th percentile of the last hundred intervals, by index."""
    e = table(spark, sf_dir, "events").select("event_type", F.col("event_id").alias("id"), "ts")
    return rounded(reconcile.percentile_gap(e, "event_type").select("event_type", F.col("id").alias("event_id"), "gap_s", "p_gap_s"), 6)


@query("SELECT event_type AS stream, isoyear(ts) AS year, week(ts) AS week, count(*) AS checks, count(*) FILTER (value * 10 > 300) AS violations, round(max(value * 10), 6) AS longest_s, round(1 - count(*) FILTER (value * 10 > 300) / count(*), 6) AS compliance FROM events GROUP BY ALL")
def fre_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRE-09: compliance, violations and the longest delay of each stream and week."""
    found = reconcile.slo_report(table(spark, sf_dir, "events"), "event_type", "ts", F.col("value") * 10, F.lit(300.0))
    return rounded(found.select("stream", F.col("year").cast("long").alias("year"), F.col("week").cast("long").alias("week"), "checks", "violations", "longest_s", "compliance"), 6)


@query(f"WITH {VIEWS['incidents']} SELECT incident_class, severity, count(*) AS n FROM incidents GROUP BY ALL")
def str_incident_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-14: incidents flushed in batches, each once."""
    i = adapters.incidents(spark, sf_dir)
    book = ledger.committed(landed(i, (F.col("incident_id") % 3).cast("int"), 3), io.scratch(spark, "incidents"), io.scratch(spark, "progress"), offsets=("agent", "incident_id"))
    return book.table("rows").groupBy("incident_class", "severity").agg(F.count("*").alias("n"))
