"""Queries on several sources at once, related ids, all leakage analyzers, audits, gaps across batches and flat series, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, incidents, leakage, validate
from ..operators.sources import Source, Tolerance, all_pairs
from ..sources import adapters, audit, io, ledger
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
    """WITH feed AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS status, o_orderdate AS ts FROM orders),
venue AS (SELECT k, price + CASE WHEN k % 29 = 0 THEN 1 WHEN k % 17 = 0 THEN 0.5 ELSE 0 END AS price, CASE WHEN k % 19 = 0 THEN 'X' ELSE lower(status) END AS status, CASE WHEN k % 23 = 0 THEN ts + INTERVAL 2 SECOND ELSE ts END AS ts FROM feed WHERE k % 13 <> 0 UNION ALL SELECT -k, price, status, ts FROM feed WHERE k % 31 = 0),
ledger AS (SELECT k, price * (1 + 1e-12) AS price, NULL::VARCHAR AS status, ts FROM feed WHERE k % 11 <> 0),
p AS (SELECT 'feed' AS source_a, 'venue' AS source_b, a.k AS ka, b.k AS kb, a.price AS pa, b.price AS pb, a.status AS sa, b.status AS sb, a.ts AS ta, b.ts AS tb, true AS has_status FROM feed a FULL JOIN venue b ON a.k = b.k
 UNION ALL SELECT 'feed', 'ledger', a.k, b.k, a.price, b.price, NULL, NULL, a.ts, b.ts, false FROM feed a FULL JOIN ledger b ON a.k = b.k UNION ALL SELECT 'venue', 'ledger', a.k, b.k, a.price, b.price, NULL, NULL, a.ts, b.ts, false FROM venue a FULL JOIN ledger b ON a.k = b.k),
d AS (SELECT source_a, source_b, coalesce(ka, kb) AS k, CASE WHEN ka IS NULL THEN 'missing_record' ELSE 'extra_record' END AS kind, NULL::VARCHAR AS field, CASE WHEN ka IS NULL THEN 'high' ELSE 'medium' END AS severity FROM p WHERE ka IS NULL OR kb IS NULL
 UNION ALL SELECT source_a, source_b, ka, 'value_mismatch', 'price', 'high' FROM p WHERE ka = kb AND abs(pa - pb) > 1e-6 AND abs(pa - pb) > 1e-9 * greatest(abs(pa), abs(pb)) UNION ALL SELECT source_a, source_b, ka, 'value_mismatch', 'status', 'low' FROM p WHERE ka = kb AND has_status AND lower(sa) <> lower(sb)
 UNION ALL SELECT source_a, source_b, ka, 'timestamp_drift', 'ts', 'low' FROM p WHERE ka = kb AND abs(epoch_us(ta) - epoch_us(tb)) > 1000000)
SELECT source_a, source_b, kind, coalesce(field, '') AS field, severity, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys FROM d GROUP BY ALL"""
)
def rec_three_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-05, REC-01, REC-06, UDF-04: three sources in one shuffle; one names its columns otherwise, writes small letters with blanks
    around them and has rows that a later one replaces; one has no status and other rounding."""
    k = F.col("k")
    feed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("ts"))
    venue = feed.where(k % 13 != 0).select(
        "k", (F.col("price") + F.when(k % 29 == 0, 1).when(k % 17 == 0, 0.5).otherwise(0)).alias("px"), F.concat(F.lit(" "), F.when(k % 19 == 0, "X").otherwise(F.lower("status"))).alias("status"),
        F.when(k % 23 == 0, F.expr("ts + INTERVAL 2 SECOND")).otherwise(F.col("ts")).alias("ts"), F.lit(2).alias("version"),
    )
    old = venue.where(k % 29 == 0).withColumns({"px": F.col("px") - 1, "version": F.lit(1)})
    venue = venue.unionByName(old).unionByName(feed.where(k % 31 == 0).select((-k).alias("k"), F.col("price").alias("px"), "status", "ts", F.lit(1).alias("version")))
    book = feed.where(k % 11 != 0).select("k", (F.col("price") * (1 + 1e-12)).alias("price"), "ts")
    sources = [Source("feed", feed, 3), Source("venue", venue, 2, {"px": "price"}, {"status": F.trim}, ("version",)), Source("ledger", book, 1)]
    found = all_pairs(sources, ["k"], ["price", "status", "ts"], ("ts",), 1.0, {"status": Tolerance(case_sensitive=False)}, {"status": "low"})
    return found.groupBy("source_a", "source_b", "kind", F.coalesce("field", F.lit("")).alias("field"), "severity").agg(F.count("*").alias("n"), F.sum("k").cast("long").alias("keys"))


@query(
    f"""WITH {VIEWS['incidents']}, r AS (SELECT a.incident_id, b.incident_id AS other, b.ts, row_number() OVER (PARTITION BY a.incident_id ORDER BY b.ts, b.incident_id) AS k, count(*) OVER (PARTITION BY a.incident_id) AS n FROM incidents a JOIN incidents b ON a.agent = b.agent AND a.incident_id <> b.incident_id AND b.ts BETWEEN a.ts - INTERVAL 30 MINUTE AND a.ts + INTERVAL 30 MINUTE)
SELECT i.incident_id, coalesce(string_agg(CAST(other AS VARCHAR), ',' ORDER BY k), '') AS related, coalesce(max(n), 0) AS related_count FROM incidents i LEFT JOIN (SELECT * FROM r WHERE k <= 50) r ON r.incident_id = i.incident_id GROUP BY i.incident_id"""
)
def join_related_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-11: the ids of the first fifty incidents of the same agent within half an hour."""
    found = incidents.related_ids(adapters.incidents(spark, sf_dir))
    return found.select("incident_id", F.array_join(F.col("related").cast("array<string>"), ",").alias("related"), "related_count")


@query(
    """WITH d AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'valid' ELSE 'test' END AS split FROM documents), s AS (SELECT text, list_sort(list(DISTINCT split)) AS gs FROM d WHERE text IS NOT NULL GROUP BY 1), z AS (SELECT g, count(*) AS size FROM (SELECT unnest(gs) AS g FROM s) GROUP BY 1),
p AS (SELECT a.g || '|' || b.g AS scope, a.size AS sa, b.size AS sb, (SELECT count(*) FROM s WHERE list_contains(gs, a.g) AND list_contains(gs, b.g)) AS v FROM z a JOIN z b ON a.g < b.g),
f AS (SELECT 'split_contamination' AS analyzer, scope, least(sa, sb) AS n, v AS violations FROM p WHERE v > 0
UNION ALL SELECT 'temporal_ordering', '', count(*), count(*) FILTER (o_orderdate > l_shipdate - INTERVAL 50 MILLISECOND) FROM lineitem JOIN orders ON l_orderkey = o_orderkey HAVING count(*) FILTER (o_orderdate > l_shipdate - INTERVAL 50 MILLISECOND) > 0
UNION ALL SELECT 'execution_edge', '', count(*), count(*) FILTER (value * 10 < 100) FROM events WHERE value * 10 >= 0 HAVING count(*) FILTER (value * 10 < 100) > 0 UNION ALL SELECT 'mempool_edge', '', count(*), count(*) FILTER (value * 100 < 100) FROM events WHERE value * 100 >= 0 HAVING count(*) FILTER (value * 100 < 100) > 0
UNION ALL SELECT 'fold_embargo', a.f || '|' || b.f, 1, 1 FROM (SELECT CAST(day(ts) % 3 AS VARCHAR) AS f, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1) a JOIN (SELECT CAST(day(ts) % 3 AS VARCHAR) AS f, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1) b ON a.f < b.f WHERE (greatest(epoch_us(a.lo), epoch_us(b.lo)) - least(epoch_us(a.hi), epoch_us(b.hi))) / 3.6e9 < 24
UNION ALL SELECT 'target_copies', feature, 1, 1 FROM (SELECT feature, avg((abs(x - y) <= 1e-10)::INT) AS same, abs(corr(x, y)) AS r, avg(abs(x - y)) / CASE WHEN stddev_pop(y) > 0 THEN stddev_pop(y) ELSE 1 END AS nmae FROM (SELECT 'discount' AS feature, l_discount AS x, l_extendedprice AS y FROM lineitem UNION ALL SELECT 'copy', l_extendedprice, l_extendedprice FROM lineitem) GROUP BY 1) WHERE same > 0.95 OR (same > 0.1 AND r > 0.99) OR nmae < 0.1), e AS (SELECT DISTINCT CAST(day(ts) % 3 AS VARCHAR) AS f, user_id FROM events), es AS (SELECT f, count(*) AS size FROM e GROUP BY 1), ep AS (SELECT a.f || '|' || b.f AS scope, count(*) AS v, a.f AS fa, b.f AS fb FROM e a JOIN e b ON a.user_id = b.user_id AND a.f < b.f GROUP BY ALL)
SELECT analyzer, scope, n, violations FROM f UNION ALL SELECT 'fold_entities', scope, least(x.size, y.size), v FROM ep JOIN es x ON x.f = fa JOIN es y ON y.f = fb"""
)
def leak_every_analyzer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LEAK-09: every analyzer whose inputs are there, all but the one of bridges."""
    docs, orders, lines, events = (table(spark, sf_dir, t) for t in ("documents", "orders", "lineitem", "events"))
    split = F.element_at(F.array(F.lit("train"), F.lit("valid"), F.lit("test")), (F.col("doc_id") % 3 + 1).cast("int"))
    delay = lambda factor: events.select(F.col("event_id").alias("id"), (F.col("value") * factor).alias("delay_ms"))
    found = leakage.analyze({
        "features": orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts")), "labels": lines.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("ts")),
        "splits": docs.select(split.alias("split"), F.col("text").alias("item")), "execution": delay(10), "mempool": delay(100),
        "folds": events.select((F.dayofmonth("ts") % 3).cast("string").alias("fold"), F.col("user_id").alias("entity"), "ts"),
        "numbers": lines.select(F.col("l_extendedprice").alias("target"), F.col("l_discount").alias("discount"), F.col("l_extendedprice").alias("copy")),
    })
    return found.select("analyzer", "scope", "n", "violations")


@query(
    """WITH e AS (SELECT * FROM events WHERE event_type <> 'error' AND value < 60)
SELECT 'clean_events' AS transformation, (SELECT count(*) FROM events) AS rows_in, count(*) AS rows_out, (SELECT count(*) FROM events) - count(*) AS rows_lost, count(*) FILTER (value > 30) AS high, count(*) FILTER (user_id % 2 = 0) AS even, min(ts) AS first, max(ts) AS last FROM e"""
)
def agg_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-44: the audit row of a transformation, counted by the run that writes."""
    row = audit.audited("clean_events", table(spark, sf_dir, "events"), lambda e: e.where("event_type <> 'error' AND value < 60"), io.scratch(spark, "clean"), "ts", {"high": F.col("value") > 30, "even": F.col("user_id") % 2 == 0}, 3600)
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return row.select("transformation", "rows_in", "rows_out", "rows_lost", F.col("checks")["high"].alias("high"), F.col("checks")["even"].alias("even"), ntz("first"), ntz("last"))


@query(
    """WITH v AS (SELECT CASE WHEN o_totalprice < 1000 OR o_totalprice > 300000 THEN 1 ELSE 0 END AS p, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS s, CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS q FROM orders)
SELECT * FROM (SELECT 'o_totalprice' AS field, CAST(sum(p) AS BIGINT) AS violations FROM v UNION ALL SELECT 'o_orderstatus', CAST(sum(s) AS BIGINT) FROM v UNION ALL SELECT 'o_orderpriority', CAST(sum(q) AS BIGINT) FROM v) WHERE violations > 0"""
)
def val_top_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-45: the fields with most violations."""
    schema = validate.Schema("orders", (validate.Field("o_totalprice", low=1000.0, high=300000.0), validate.Field("o_orderstatus", allowed=("O", "F")), validate.Field("o_orderpriority", allowed=("1-URGENT", "2-HIGH"))))
    return validate.top_fields(validate.violations(table(spark, sf_dir, "orders"), schema)).select("field", "violations")


@query("WITH g AS (SELECT event_id AS id, event_type, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1e6 AS gap_s FROM events) SELECT id, event_type, round(gap_s, 4) AS gap_s FROM g WHERE gap_s > 5400")
def ano_gaps_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-13: gaps above an hour and a half in four batches that each know the last row of each series before them."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    book = ledger.committed(landed(e, F.floor((F.dayofmonth("ts") - 1) / 8), 4), io.scratch(spark, "gaps"), io.scratch(spark, "progress"), anomaly.gaps_step(["event_type"], "event_id", 3600))
    return rounded(book.table("gaps").select("id", "event_type", "gap_s"), 4)


@query(
    """WITH s AS (SELECT event_type, ts, event_id, CASE WHEN event_id % 800 < 400 THEN 5.0 WHEN event_id % 1600 < 800 THEN 5.005 ELSE 5.5 END::DOUBLE AS value FROM events),
w AS (SELECT event_type, event_id, row_number() OVER o AS n, list(value) OVER (o ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS new, list(value) OVER (o ROWS BETWEEN 99 PRECEDING AND 50 PRECEDING) AS old FROM s WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id)),
m AS (SELECT *, list_aggregate(old, 'median') AS mo, list_aggregate(new, 'median') AS mn FROM w WHERE n >= 100), d AS (SELECT *, list_aggregate(list_transform(old, lambda x: abs(x - mo)), 'median') AS mad FROM m)
SELECT event_type, event_id, round(abs(mn - mo) / 0.01, 6) AS shift FROM d WHERE mad < 1e-10 AND (abs(mn - mo) > 0.01 OR abs(mn - mo) > 0.1 * abs(mo))"""
)
def ano_flat_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-10: series that stand still, then jump: by little, which is none, and by more."""
    i = F.col("event_id")
    s = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", F.when(i % 800 < 400, 5.0).when(i % 1600 < 800, 5.005).otherwise(5.5).alias("value"))
    found = anomaly.level_shifts(s, ["event_type"], ["ts", "event_id"], 50)
    return rounded(found.where("flat").select("event_type", "event_id", "shift"), 6)


@query(
    """WITH w AS (SELECT event_type, event_id, value, row_number() OVER o AS n, list(value) OVER (o ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS l FROM events WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id)),
m AS (SELECT *, list_aggregate(l, 'median') AS med FROM w WHERE n >= 60), d AS (SELECT *, 1.4826 * list_aggregate(list_transform(l, lambda x: abs(x - med)), 'median') AS sd FROM m)
SELECT event_type, event_id, round(abs(value - med) / sd, 6) AS z FROM d WHERE sd > 0 AND abs(value - med) / sd > 4"""
)
def ano_robust_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-03: spikes by median and median absolute deviation of the last sixty values."""
    s = table(spark, sf_dir, "events").select("event_type", "event_id", "ts", "value")
    return rounded(anomaly.robust_spikes(s, ["event_type"], ["ts", "event_id"], 4, 60, 60).select("event_type", "event_id", "z"), 6)


@query(
    """WITH t AS (SELECT event_type, event_id, ts, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS sd FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 549 PRECEDING AND CURRENT ROW)),
b AS (SELECT *, (n >= 100 AND sd > 0 AND abs(value - m) / sd > 1)::INT AS hit FROM t), s AS (SELECT *, sum(hit) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS hits FROM b) SELECT event_type, event_id FROM s WHERE hit = 1 AND hits >= 4"""
)
def ano_debounced_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANO-05: breaches of which there are four among the last ten rows."""
    s = anomaly.statistics(table(spark, sf_dir, "events").select("event_type", "event_id", "ts", "value"), ["event_type"], ["ts", "event_id"])
    return anomaly.spikes(s, 1, 100, 4, ["event_type"], ["ts", "event_id"], 10).select("event_type", "event_id")
