"""As-of joins by union and a carried last value (JOIN-07 to JOIN-09): one shuffle on the key and range of time, no range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, on: str, by: list[str], values: list[str], direction: str = "backward", tolerance_us: int | None = None, strict: bool = False, step_s: int = 86400) -> DataFrame:
    """left with the values of the right row of the same key nearest in time at or before (backward) or at or after (forward).

    A matched row's time is in `matched_ts`; without one in reach the values are null. Of right rows of one time the one whose values
    sort last counts. With strict, a row of the same time doesn't match. Both times have one type. Null keys match null keys, rows
    without a time match nothing. A key's rows are cut into ranges of step_s seconds; each range begins with the value that the
    ranges before it leave, one row per range, so that a hot key is many tasks.
    """
    keys = by or []
    backward = direction == "backward"
    us = F.unix_micros(F.col("_ts").cast("timestamp"))
    row = F.struct(F.col(on).alias("ts"), *[F.col(v) for v in values])
    none = lambda kind: F.lit(None).cast(kind)
    rights = right.where(F.col(on).isNotNull()).select(*keys, F.col(on).alias("_ts"), row.alias("_r"))
    lefts = left.select(*keys, F.col(on).alias("_ts"), F.struct(*left.columns).alias("_l"))
    ranged = lambda df: df.withColumn("_range", F.floor(us / (step_s * 1000000)).cast("long"))
    rights, lefts = ranged(rights), ranged(lefts)
    nearer = F.struct(us if backward else -us, "_r")
    ends = rights.groupBy(*keys, "_range").agg(F.max_by("_r", nearer).alias("_r")).unionByName(lefts.select(*keys, "_range").distinct().withColumn("_r", none(rights.schema["_r"].dataType)))
    order = F.col("_range") if backward else F.col("_range").desc()
    carried = ends.groupBy(*keys, "_range").agg(F.max("_r").alias("_r"))  # one row per range, with or without right rows
    carried = carried.withColumn("_r", F.last("_r", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)))
    kind = lefts.schema["_l"].dataType
    both = lefts.withColumn("_r", none(rights.schema["_r"].dataType)).withColumn("_first", F.lit(1))
    both = both.unionByName(rights.withColumn("_l", none(kind)).withColumn("_first", F.lit(1)))
    both = both.unionByName(carried.where("_r IS NOT NULL AND _range IS NOT NULL").withColumn("_ts", none(lefts.schema["_ts"].dataType)).withColumn("_l", none(kind)).withColumn("_first", F.lit(0)))
    is_left = F.col("_l").isNotNull().cast("int")
    w = Window.partitionBy(*keys, "_range").orderBy("_first", F.col("_ts").asc() if backward else F.col("_ts").desc(), -is_left if strict else is_left, F.col("_r").asc_nulls_last())
    out = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_l").isNotNull())
    if tolerance_us is not None:
        gap = F.abs(us - F.unix_micros(F.col("_m.ts").cast("timestamp")))
        out = out.withColumn("_m", F.when(gap <= tolerance_us, F.col("_m")))
    return out.select("_l.*", F.col("_m.ts").alias("matched_ts"), *[F.col(f"_m.{v}").alias(f"{v}_asof") for v in values])


def nearest(left: DataFrame, right: DataFrame, on: str, by: list[str], value: str, at: Column, tolerance_us: Column) -> DataFrame:
    """left with the value of the right row nearest to the time `at` (a column of left), the earlier of two equally near, within the
    tolerance (JOIN-08)."""
    l = left.withColumn("_at", at)
    r = right.select(*by, F.col(on).alias("_at"), F.col(value).alias("v"))
    back = asof(l.withColumnRenamed("matched_ts", "m") if "matched_ts" in l.columns else l, r, "_at", by, ["v"]).withColumnsRenamed({"matched_ts": "_bt", "v_asof": "_bv"})
    fwd = asof(back, r, "_at", by, ["v"], direction="forward").withColumnsRenamed({"matched_ts": "_ft", "v_asof": "_fv"})
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    db, df = us("_at") - us("_bt"), us("_ft") - us("_at")
    pick_back = df.isNull() | (db <= df)
    gap = F.when(pick_back, db).otherwise(df)
    return fwd.withColumn(f"{value}_nearest", F.when(gap <= tolerance_us, F.when(pick_back, F.col("_bv")).otherwise(F.col("_fv")))).drop("_at", "_bt", "_bv", "_ft", "_fv")
