"""Reconciliation of sources (REC-01 to REC-10, JOIN-05, JOIN-06) and freshness of streams (FRE-01 to FRE-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .anomaly import middles
from .blocks import blocks


def equal(a: Column, b: Column, absolute: float = 1e-6, relative: float = 1e-9) -> Column:
    """Numbers that agree within a tolerance; nulls equal nulls (REC-01)."""
    near = F.abs(a - b) <= F.greatest(F.lit(absolute), relative * F.greatest(F.abs(a), F.abs(b)))
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(near)


def compare(a: DataFrame, b: DataFrame, keys: list[str], fields: list[str], times: tuple[str, ...] = (), drift_s: float = 1.0, **tolerance: float) -> DataFrame:
    """A row per discrepancy of two sources: (keys, kind, field, value_a, value_b); kinds missing_in_a, missing_in_b, value_mismatch,
    timestamp_drift. Keys match null-safely; of repeated keys in a source the largest row counts."""
    one = lambda df, x: df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias(x))
    left, right = one(a, "ra"), one(b, "rb")
    on = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        on = c if on is None else on & c
    j = left.join(right, on, "full_outer").select(*[F.coalesce(left[k], right[k]).alias(k) for k in keys], "ra", "rb")
    found = [F.when(F.col("ra").isNull(), F.struct(F.lit("missing_in_a").alias("kind"), F.lit(None).cast("string").alias("field"))), F.when(F.col("rb").isNull(), F.struct(F.lit("missing_in_b").alias("kind"), F.lit(None).cast("string").alias("field")))]
    both = F.col("ra").isNotNull() & F.col("rb").isNotNull()
    for f in fields:
        x, y = F.col(f"ra.{f}"), F.col(f"rb.{f}")
        if f in times:
            differ = F.abs(F.unix_micros(x.cast("timestamp")) - F.unix_micros(y.cast("timestamp"))) > drift_s * 1e6
            found.append(F.when(both & F.coalesce(differ, F.lit(True)), F.struct(F.lit("timestamp_drift").alias("kind"), F.lit(f).alias("field"))))
        else:
            found.append(F.when(both & ~equal(x, y, **tolerance), F.struct(F.lit("value_mismatch").alias("kind"), F.lit(f).alias("field"))))
    shown = lambda side: F.coalesce(*[F.when(F.col("d.field") == f, F.col(f"{side}.{f}").cast("string")) for f in fields])
    return j.select(*keys, "ra", "rb", F.explode(F.array_compact(F.array(*found))).alias("d")).select(*keys, "d.kind", "d.field", shown("ra").alias("value_a"), shown("rb").alias("value_b"))


IMPORTANT = ("price", "amount", "balance", "quantity", "total")


def rated(found: DataFrame, priority_a: int, priority_b: int) -> DataFrame:
    """Discrepancies with severity, symmetric id and proposed fix (REC-06 to REC-08)."""
    weighty = F.lit(False)
    for w in IMPORTANT:
        weighty = weighty | F.coalesce(F.contains("field", F.lit(w)), F.lit(False))
    level = F.when(F.col("kind") == "timestamp_drift", "low").when(F.col("kind") == "value_mismatch", F.when(weighty, "high").otherwise("medium")).when(F.col("kind") == ("missing_in_a" if priority_a > priority_b else "missing_in_b"), "high").otherwise("medium")
    fix = F.lit("manual_review") if priority_a == priority_b else F.lit("take_a" if priority_a > priority_b else "take_b")
    return found.withColumn("severity", level).withColumn("fix", fix)


def report(found: DataFrame) -> DataFrame:
    """Discrepancies by kind, field and severity (REC-09)."""
    return found.groupBy("kind", F.coalesce("field", F.lit("")).alias("field"), "severity").agg(F.count("*").alias("n"))


def order_differences(a: DataFrame, b: DataFrame, key: str, by: str) -> DataFrame:
    """Keys that both sources have at different places of their order; ties go by key (REC-05). Ranks are global: a total order is
    asked for, which Spark sorts by range."""
    common = a.select(key, F.col(by).alias("va")).join(b.select(key, F.col(by).alias("vb")), key)
    from_ranges = lambda c: ranks(common, [c, key], key).withColumnRenamed("rank", f"rank_{c}")
    return from_ranges("va").join(from_ranges("vb"), key).where("rank_va <> rank_vb")


def ranks(df: DataFrame, order: list[str], key: str, buckets: int = 64) -> DataFrame:
    """(key, rank from 0) in a total order without one global window: quantile buckets of the first column, counted and offset."""
    edges = df.agg(F.percentile_approx(order[0], F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), 10000).alias("e"))
    b = df.join(F.broadcast(edges)).withColumn("bucket", F.size(F.filter("e", lambda x: x < F.col(order[0])))).drop("e")
    sizes = b.groupBy("bucket").agg(F.count("*").alias("n"))
    offset = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")  # `buckets` rows
    w = Window.partitionBy("bucket").orderBy(*order)
    return b.join(F.broadcast(offset), "bucket").withColumn("rank", F.col("before") + F.row_number().over(w) - 1).select(key, "rank")


def intervals(stream: DataFrame, key: str, length: int = 200) -> DataFrame:
    """Per arrival the statistics of the gaps so far: mean and sample deviation of the last 100, median and robust deviation (jitter) of
    the positive ones among the last `length`, and whether the stream is armed (FRE-01, FRE-05)."""
    w = Window.partitionBy(key, "_block").orderBy("_n")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    s = blocks(stream, [key], "ts", ["ts", "id"], max(length, 100) + 1)
    s = s.withColumn("gap_s", (us - F.lag(us).over(w)) / 1000000).withColumn("positive", F.when(F.col("gap_s") > 0, F.col("gap_s")))
    last, long = w.rowsBetween(-99, 0), w.rowsBetween(-(length - 1), 0)
    s = s.withColumns({"mean_gap": F.avg("gap_s").over(last), "sd_gap": F.stddev_samp("gap_s").over(last)})
    s = middles(s, "positive", long, "bar", "_mad").where("_own").withColumn("seen", F.col("_n"))
    steady = (F.col("seen") >= 3) & (F.col("sd_gap") / F.col("mean_gap") < 0.2)
    return s.withColumn("jitter", 1.4826 * F.col("_mad")).withColumn("armed", (F.col("seen") >= 10) | F.coalesce(steady, F.lit(False))).drop("_mad", "_n", "_block", "_own", "positive")


def percentile_gap(stream: DataFrame, key: str, share: float = 0.95, length: int = 100) -> DataFrame:
    """Per arrival the gap before it, and that of rank share * n (rounded down, from 0) of the last `length` gaps in order of size (FRE-01);
    null before the first gap."""
    w = Window.partitionBy(key, "_block").orderBy("_n")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    s = blocks(stream, [key], "ts", ["ts", "id"], length + 1).withColumn("gap_s", (us - F.lag(us).over(w)) / 1000000)
    gaps = F.array_sort(F.collect_list("gap_s").over(w.rowsBetween(-(length - 1), 0)))  # `length` values at most
    return s.withColumn("p_gap_s", F.get(gaps, F.least(F.floor(F.size(gaps) * share), F.size(gaps) - 1).cast("int"))).where("_own").drop("_n", "_block", "_own")


def slo_report(checks: DataFrame, stream: str, ts: str, age_s: Column, limit_s: Column) -> DataFrame:
    """Per stream and ISO week: checks, violations (age above the limit), their compliance and the longest age (FRE-09). Checks without an
    age are violations."""
    late = F.coalesce(age_s > limit_s, F.lit(True))
    out = checks.groupBy(F.col(stream).alias("stream"), F.extract(F.lit("YEAROFWEEK"), F.col(ts)).alias("year"), F.weekofyear(ts).alias("week")).agg(F.count("*").alias("checks"), F.count_if(late).alias("violations"), F.max(age_s).alias("longest_s"))
    return out.withColumn("compliance", 1 - F.col("violations") / F.col("checks"))


def threshold(bar: Column, jitter: Column, expected_s: Column, armed: Column) -> Column:
    """Seconds after which a stream is stale (FRE-02)."""
    held = lambda x: F.greatest(F.lit(10.0), F.least(F.lit(3600.0), x))
    return F.when(~armed, 2 * expected_s).otherwise(F.coalesce(held(1.5 * bar + 2 * jitter), held(1.5 * expected_s)))


def level(age_s: Column, limit_s: Column) -> Column:
    return F.when(age_s <= limit_s, "fresh").when(age_s <= 2 * limit_s, "stale").when(age_s <= 4 * limit_s, "very_stale").otherwise("critical")


#: Seconds up to which a score holds, by class of data.
SCORES = {"execution": ((10, 1.0), (20, 0.98), (30, 0.95), (40, 0.92), (50, 0.9)), "analysis": ((300, 1.0), (600, 0.98), (900, 0.95), (1200, 0.92), (1500, 0.9)), "historical": ((86400, 0.95),)}
LOWEST = {"execution": 0.85, "analysis": 0.85, "historical": 0.9}


def score(age_s: Column, kind: str) -> Column:
    """Freshness score of a data class; more than 5 s in the future 0.8, without a time 0.9 (FRE-11)."""
    out = F.when(age_s.isNull(), 0.9).when(age_s < -5, 0.8)
    for limit, value in SCORES[kind]:
        out = out.when(age_s <= limit, value)
    return out.otherwise(LOWEST[kind])


def outside_pauses(rows: DataFrame, pauses: DataFrame, key: str, ts: str, grace_s: int = 30) -> DataFrame:
    """Rows outside their stream's planned pauses and the grace after them (FRE-08), by the newest pause that began before."""
    from .asof import asof

    p = pauses.select(key, F.col("start").alias(ts), F.col("end"))
    j = asof(rows, p, ts, [key], ["end"])
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    inside = F.col("end_asof").isNotNull() & (us(ts) <= us("end_asof") + grace_s * 1000000)
    return j.where(~inside).drop("matched_ts", "end_asof")


def weekly(incidents: DataFrame, false_positive: Column, target: int) -> DataFrame:
    """Per ISO week and stream: incidents, false positives and whether they reach the target (FRE-09, FRE-12)."""
    return incidents.groupBy(F.weekofyear("ts").alias("week"), "stream").agg(F.count("*").alias("n"), F.count_if(false_positive).alias("false_positives")).withColumn("over_budget", F.col("false_positives") >= target)


def alarm_confidence(ratio: Column, n: Column, cv: Column, fp_rate: Column, weekly: Column, target: float) -> Column:
    """How sure a staleness is, from 0.1 to 1 (FRE-07): by its ratio to the threshold, the number and the coefficient of variation of
    the intervals, the stream's false positives and how near the week's false positives come to their target."""
    distance = F.when(ratio < 1.5, 0.6).when(ratio > 3.0, 1.1).otherwise(1.0)
    seen = F.when(n < 5, 0.7).when(n > 20, 1.05).otherwise(1.0)
    steady = F.when(n < 3, 1.0).when(cv < 0.1, 1.1).when(cv > 0.5, 0.8).otherwise(1.0)
    past = F.when(fp_rate > 0.1, 1.0 - F.least(F.lit(0.3), fp_rate)).otherwise(1.0)
    pressed = F.when(weekly >= 0.8 * target, 0.7).otherwise(1.0)
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), distance * seen * steady * past * pressed))


def alarm_gate(level_: Column, sure: Column, weekly: Column, target: float) -> Column:
    """Whether an incident is opened (FRE-12): critical ones always, others above a confidence of 0.9 once the week's target is met."""
    return (level_ == "critical") | (weekly < target) | (sure > 0.9)
