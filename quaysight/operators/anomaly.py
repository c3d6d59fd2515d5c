"""Anomalies of series (ANO-01 to ANO-17): rolling statistics over one window per series, and checks on them.

series has the key columns, ts, an id that makes the order total, and value. Windows hold the current value and the `LENGTH` - 1 before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.ledger import Step
from .blocks import blocks, lagged, summed

LENGTH = 550


def unpivoted(df: DataFrame, ids: list[str], fields: list[str], table: str) -> DataFrame:
    """(ids, table, field, value) of the numeric fields."""
    return df.select(*ids, F.lit(table).alias("table"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields])).alias("v")).select(*ids, "table", "v.field", "v.value")


def statistics(series: DataFrame, keys: list[str], order: list[str], robust: bool = False) -> DataFrame:
    """series with n, mean, sd (of the sample), low and high, and the median if asked for, of the last LENGTH rows (ANO-01, ANO-02).
    Rows without a key give none. Keys are cut into blocks."""
    whole = Window.partitionBy(*keys, "_block")
    so_far = whole.orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    w = whole.orderBy("_n").rowsBetween(-(LENGTH - 1), 0)
    # Differences of running sums of the centred values: a row costs the same for any length of the frame.
    out = blocks(series.dropna(subset=keys), keys, order[0], order, LENGTH).withColumn("_centre", F.avg("value").over(whole)).withColumn("_c", F.col("value") - F.col("_centre"))
    out = out.withColumns({"_k": F.count("_c").over(so_far), "_s": F.coalesce(F.sum("_c").over(so_far), F.lit(0.0)), "_q": F.coalesce(F.sum(F.col("_c") * F.col("_c")).over(so_far), F.lit(0.0))})
    since = lambda c, zero: F.col(c) - F.lag(c, LENGTH, zero).over(whole.orderBy("_n"))
    out = out.withColumns({"n": since("_k", 0), "_ds": since("_s", 0.0), "_dq": since("_q", 0.0), "low": F.min("value").over(w), "high": F.max("value").over(w)})
    n = F.col("n")
    mean = F.col("_ds") / F.when(n > 0, n)
    sd = F.when(n > 1, F.sqrt(F.greatest((F.col("_dq") - n * mean * mean) / (n - 1), F.lit(0.0))))
    out = out.withColumns({"mean": F.when(n > 0, F.col("_centre") + mean), "sd": sd})
    out = out.withColumn("median", F.percentile("value", 0.5).over(w)) if robust else out
    return out.where("_own").drop("_centre", "_c", "_k", "_s", "_q", "_ds", "_dq", "_n", "_block", "_own")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), where x is computed once, however often f names it and wherever a filter on the result is pushed to."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def middle(a: Column) -> Column:
    """The median of a sorted array; null of an empty one."""
    at = lambda v, i: F.get(v, F.floor(i).cast("int"))
    return let(a, lambda v: F.when(F.size(v) > 0, (at(v, (F.size(v) - 1) / 2) + at(v, F.size(v) / 2)) / 2))


def middles(df: DataFrame, column: str, window, median: str, deviation: str) -> DataFrame:
    """df with the median of the column's values in the window and their median absolute deviation (ANO-02). A frame's values are
    gathered once per row, so that the window must be bounded."""
    out = df.withColumn("_v", F.sort_array(F.collect_list(column).over(window))).withColumn(median, middle(F.col("_v")))
    return out.withColumn(deviation, let(F.col(median), lambda m: middle(F.sort_array(F.transform("_v", lambda x: F.abs(x - m)))))).drop("_v")


def mad(series: DataFrame, keys: list[str], order: list[str], length: int) -> DataFrame:
    """series with the median and the median absolute deviation of the last `length` values (ANO-02). Keys are cut into blocks."""
    w = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-(length - 1), 0)
    return middles(blocks(series, keys, order[0], order, length), "value", w, "median", "mad").where("_own").drop("_n", "_block", "_own")


def since(before: str) -> Column:
    """Seconds from the time in a column to ts."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return (us("ts") - us(before)) / 1000000


def severity(x: Column, limits: tuple[float, float, float]) -> Column:
    return F.when(x >= limits[2], "critical").when(x >= limits[1], "high").when(x >= limits[0], "medium").otherwise("low")


def spikes(stats: DataFrame, z: float, least: int, run: int = 1, keys: list[str] | None = None, order: list[str] | None = None, within: int | None = None) -> DataFrame:
    """Values more than z deviations from the mean once there are `least`, in at least `run` rows running (ANO-03, ANO-05, ANO-06); with
    `within`, in at least `run` of so many rows up to the value's, which is one of them."""
    score = F.when((F.col("n") >= least) & (F.col("sd") > 0), F.abs(F.col("value") - F.col("mean")) / F.col("sd"))
    out = stats.withColumn("z", score).withColumn("breach", F.coalesce(F.col("z") > z, F.lit(False)))
    if run > 1:
        reach = max(run, within or run)
        w = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-(reach - 1), 0)
        out = blocks(out, keys, order[0], order, reach).withColumn("breach", F.col("breach") & (F.sum(F.col("breach").cast("int")).over(w) >= run))
        out = out.where("_own").drop("_n", "_block", "_own")
    return out.where("breach").withColumn("severity", severity(F.col("z"), (4, 6, 10))).drop("breach")


def robust_spikes(series: DataFrame, keys: list[str], order: list[str], z: float = 3, length: int = 100, least: int = 100) -> DataFrame:
    """Values more than z robust deviations, 1.4826 times the median absolute one, from the median of the last `length` values, once there
    are `least` (ANO-03). A deviation of 0 gives none."""
    w = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-(length - 1), 0)
    s = middles(blocks(series, keys, order[0], order, length).withColumn("n", F.count("value").over(w)), "value", w, "median", "mad").where("_own").drop("_n", "_block", "_own")
    score = F.when((F.col("n") >= least) & (F.col("mad") > 0), F.abs(F.col("value") - F.col("median")) / (1.4826 * F.col("mad")))
    return s.withColumn("z", score).where(F.col("z") > z).withColumn("severity", severity(F.col("z"), (4, 6, 10)))


def flatlines(series: DataFrame, keys: list[str], order: list[str], least: int = 10) -> DataFrame:
    """Runs of at least so many equal values, by islands between changes (ANO-08)."""
    before = F.col("_before.value")
    change = F.when(before.isNull() | (F.abs(F.col("value") - before) > 1e-6 + 1e-9 * F.abs(before)), 1).otherwise(0)
    s = summed(lagged(series, keys, order[0], order, ["value"]).withColumn("_c", change.cast("long")), keys, order[0], order, "_c", "_g")
    return s.groupBy(*keys, "_g").agg(F.count("*").alias("length"), F.min("ts").alias("start"), F.max("ts").alias("end")).where(F.col("length") >= least).drop("_g").withColumn("severity", severity(F.col("length"), (25, 50, 100)))


def discontinuities(series: DataFrame, keys: list[str], order: list[str], gap_s: float = 60, slope: float = 5) -> DataFrame:
    """Jumps of value per second above the slope after gaps of at least gap_s (ANO-09)."""
    s = lagged(series, keys, order[0], order, ["ts", "value"])
    s = s.withColumn("gap_s", since("_before.ts")).withColumn("jump", F.abs(F.col("value") - F.col("_before.value"))).drop("_before")
    return s.where((F.col("gap_s") >= gap_s) & (F.col("jump") / F.col("gap_s") > slope))


def level_shifts(series: DataFrame, keys: list[str], order: list[str], half: int = 250, z: float = 3, absolute: float = 0.01, relative: float = 0.1) -> DataFrame:
    """Rows where the medians of the newer and the older half differ by more than z robust deviations of the older, 1.4826 times its
    median absolute deviation (ANO-10). Where the older half is flat (a deviation below 1e-10) they differ by more than `absolute`, or
    by more than `relative` of the older median if that isn't 0; shift is the difference in units of `absolute` then."""
    own = [*keys, "_block"]
    s = blocks(series, keys, order[0], order, 2 * half)
    w = Window.partitionBy(*own).orderBy("_n")
    new, old = w.rowsBetween(-(half - 1), 0), w.rowsBetween(-(2 * half - 1), -half)
    s = s.withColumns({"n_old": F.count("value").over(old), "_new": F.sort_array(F.collect_list("value").over(new))})
    s = middles(s, "value", old, "median_old", "_mad").where("_own").withColumn("median_new", middle(F.col("_new")))
    apart, base = F.abs(F.col("median_new") - F.col("median_old")), F.abs("median_old")
    moved = (apart > absolute) | ((base > 1e-10) & (apart > relative * base))
    flat = F.col("_mad") < 1e-10
    shift = F.when(flat, F.when(moved, apart / absolute)).otherwise(F.when(apart / (1.4826 * F.col("_mad")) > z, apart / (1.4826 * F.col("_mad"))))
    return s.where(F.col("n_old") == half).withColumns({"shift": shift, "flat": flat}).where("shift IS NOT NULL").drop("_mad", "_new", "_n", "_block", "_own")


def repeats(rows: DataFrame, row_hash: Column, within_s: float = 300) -> DataFrame:
    """Rows whose hash occurred within the seconds before (ANO-12)."""
    s = lagged(rows.withColumn("row_hash", row_hash), ["row_hash"], "ts", ["ts", "id"], ["ts"]).withColumn("since_s", since("_before.ts")).drop("_before")
    return s.where(F.col("since_s") <= within_s)


def gaps(series: DataFrame, keys: list[str], order: list[str], expected_s: float) -> DataFrame:
    """Gaps above one and a half times the expected interval (ANO-13)."""
    s = lagged(series, keys, order[0], order, ["ts"]).withColumn("gap_s", since("_before.ts")).drop("_before").where(F.col("gap_s") > 1.5 * expected_s)
    return s.withColumn("multiple", F.col("gap_s") / expected_s).withColumn("severity", severity(F.col("multiple"), (5, 10, 20)))


def gaps_step(keys: list[str], id_col: str, expected_s: float) -> Step:
    """A step for a ledger: table `gaps` of each batch, and the state `last`, the newest row of each series so far, after which the next
    batch's rows come (ANO-13). Rows that aren't newer than it give no gap; each batch reads a row per series besides its own."""

    def step(rows: DataFrame, state: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        new = rows.select(*keys, F.col(id_col).alias("id"), "ts").where("ts IS NOT NULL")
        both = new.withColumn("_old", F.lit(False))
        if "last" in state:
            both = both.unionByName(state["last"].withColumn("_old", F.lit(True)))
        found = gaps(both, keys, ["ts", "id"], expected_s).where("NOT _old").drop("_old")
        newest = F.max_by(F.struct("id", "ts"), F.struct("ts", "id")).alias("_r")
        return {"gaps": found}, {"last": both.groupBy(*keys).agg(newest).select(*keys, "_r.id", "_r.ts")}

    return step


def adaptive(series: DataFrame, keys: list[str], order: list[str], base: float = 3.0, sensitivity: float = 0.5, length: int = 100, recent: int = 20) -> DataFrame:
    """Spikes against a threshold that grows with the coefficient of variation and with the share of breaches among the last `recent`
    rows (ANO-04). The threshold depends on earlier breaches, so each series is walked once in order, in batches; it keeps the
    last `length` values only."""
    import pyarrow as pa

    names = [f"k{i}" for i in range(len(keys))]
    rows = series.select(*[F.col(k).cast("string").alias(n) for k, n in zip(keys, names)], F.col(order[-1]).cast("long").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.col("value").cast("double").alias("value"))
    rows = rows.repartition(*names).sortWithinPartitions(*names, "us", "id")

    def walk(batches):
        from collections import deque
        from math import sqrt

        key, values, hits, total, squares = None, deque(maxlen=length), deque(maxlen=recent), 0.0, 0.0
        for batch in batches:
            out = []
            for *k, i, _, v in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    key, values, hits, total, squares = k, deque(maxlen=length), deque(maxlen=recent), 0.0, 0.0
                if v is None:
                    continue
                gone = values[0] if len(values) == length else 0.0
                values.append(v)
                total, squares = total + v - gone, squares + v * v - gone * gone
                breach = False
                if len(values) == length:
                    mean = total / length
                    sd = sqrt(max((squares - length * mean * mean) / (length - 1), 0.0))
                    cv = min(sd / abs(mean), 1) if mean else 1.0
                    limit = base * (1 + sensitivity * cv) * (1 + sensitivity * min(sum(hits) / recent, 0.5))
                    breach = sd > 0 and abs(v - mean) / sd > limit
                hits.append(breach)
                if breach:
                    out.append((*k, i, v, abs(v - mean) / sd, limit))
            cols = list(zip(*out)) or [()] * (len(names) + 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string()] * len(names) + [pa.int64(), pa.float64(), pa.float64(), pa.float64()])], names=[*names, "id", "value", "z", "threshold"])

    return rows.mapInArrow(walk, ", ".join([*(f"{n} string" for n in names), "id long, value double, z double, threshold double"])).withColumnsRenamed(dict(zip(names, keys)))


def analysed(rows: DataFrame, table: str, id_col: str, ts: str, fields: list[str], row_hash: Column, z: float = 3.0, least: int = 100, expected_s: float = 600.0, slope: float = 0.5) -> DataFrame:
    """Every check on a batch of rows in order of (ts, id): spikes, jumps, flat runs and non-finite values of each field, repeated rows
    and gaps (ANO-17). (kind, table, field, id, measure, threshold, method, evidence): evidence is a map of the field's figures at that
    row (ANO-16); checks of whole rows have no field and no figures."""
    base = rows.withColumns({"_id": F.col(id_col), "_ts": F.col(ts)})
    long = unpivoted(base, ["_id", "_ts"], fields, table).withColumnsRenamed({"_id": "id", "_ts": "ts"})
    finite = ~F.isnan("value") & (F.abs("value") < float("inf"))
    odd, good = long.where(~finite), long.where(finite)  # neither has nulls
    stats = statistics(good, ["table", "field"], ["ts", "id"])
    figures = F.create_map(*[x for c in ("n", "mean", "sd", "low", "high") for x in (F.lit(c), F.col(c).cast("double"))])
    none = F.lit(None).cast("map<string,double>")

    def found(df: DataFrame, kind: str, field: Column, measure: str, threshold: float, method: str, evidence: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.lit(table).alias("table"), field.alias("field"), F.col("id").cast("long").alias("id"), F.col(measure).cast("double").alias("measure"), F.lit(float(threshold)).alias("threshold"), F.lit(method).alias("method"), evidence.alias("evidence"))

    series = base.select(F.lit(table).alias("table"), F.col("_id").alias("id"), F.col("_ts").alias("ts"))
    field, whole = F.col("field"), F.lit(None).cast("string")
    runs = flatlines(good.withColumn("_last", F.struct("ts", "id")), ["table", "field"], ["ts", "id"])
    out = found(spikes(stats, z, least), "spike", field, "z", z, "rolling_z", figures)
    out = out.unionByName(found(discontinuities(good, ["table", "field"], ["ts", "id"], 60, slope), "jump", field, "jump", slope, "slope", none))
    out = out.unionByName(found(runs.withColumn("id", F.lit(None).cast("long")), "flatline", field, "length", 10, "islands", none))
    out = out.unionByName(found(odd, "non_finite", field, "value", 0, "finite", none))
    out = out.unionByName(found(repeats(base.withColumnsRenamed({"_id": "id_", "_ts": "ts_"}).select(F.col("id_").alias("id"), F.col("ts_").alias("ts"), row_hash.alias("_h")), F.col("_h")), "repeated_row", whole, "since_s", 300, "row_hash", none))
    return out.unionByName(found(gaps(series, ["table"], ["ts", "id"], expected_s), "gap", whole, "gap_s", 1.5 * expected_s, "interval", none))
