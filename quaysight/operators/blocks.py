"""Long series cut into blocks, so that windows of bounded frames don't put a whole key into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranged(df: DataFrame, column: str, step_s: int = 86400) -> DataFrame:
    """df with _range, the number of the range of step_s seconds that the time in the column lies in; of a number, of step_s units."""
    of = F.col(column)
    if df.select(of.alias("x")).schema["x"].dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
        of = F.unix_micros(of.cast("timestamp")) / 1000000
    return df.withColumn("_range", F.floor(of / step_s).cast("long"))


def numbered(df: DataFrame, keys: list[str], ts: str, order: list[str], step_s: int = 86400) -> DataFrame:
    """df with _n, the number from 1 of each row of its key in order, whose first column is `ts`, a time or a number."""
    return summed(df.withColumn("_one", F.lit(1).cast("long")), keys, ts, order, "_one", "_n", step_s).drop("_one")


def summed(df: DataFrame, keys: list[str], ts: str, order: list[str], column: str, name: str, step_s: int = 86400, of: Callable[[str], Column] = F.sum) -> DataFrame:
    """df with the sum (or another such aggregate, as the largest) of the column over its key's rows up to each, in order, whose first
    column is `ts`. Ranges of rows are summed up one by one, after a row that carries the sum of the ranges before. Null keys are one
    key, rows without `ts` come first."""
    r = ranged(df, ts, step_s)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    carried = r.groupBy(*keys, "_range").agg(of(column).alias(column)).withColumn(column, of(column).over(before).cast(df.schema[column].dataType))
    return _after(r, carried, keys).withColumn(name, of(column).over(_within(keys, order).rowsBetween(Window.unboundedPreceding, 0))).where("_own_row").drop("_range", "_own_row")


def lagged(df: DataFrame, keys: list[str], ts: str, order: list[str], columns: list[str], name: str = "_before", step_s: int = 86400) -> DataFrame:
    """df with a struct of the columns of its key's row before each, null at the first, in order, whose first column is `ts`. A range of
    rows begins with a row that carries the last one of the ranges before. Null keys are one key, rows without `ts` come first."""
    r = ranged(df, ts, step_s).withColumn("_now", F.struct(*columns))
    ends = r.groupBy(*keys, "_range").agg(F.max_by("_now", F.struct(*order)).alias("_now"))
    carried = ends.withColumn("_now", F.lag("_now").over(Window.partitionBy(*keys).orderBy("_range"))).where("_now IS NOT NULL")
    return _after(r, carried, keys).withColumn(name, F.lag("_now").over(_within(keys, order))).where("_own_row").drop("_range", "_own_row", "_now")


def _after(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("_own_row", F.lit(True)).unionByName(carried.withColumn("_own_row", F.lit(False)), allowMissingColumns=True)


def _within(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, "_range").orderBy("_own_row", *order)


def blocks(df: DataFrame, keys: list[str], ts: str, order: list[str], halo: int, rows: int = 4096, step_s: int = 86400) -> DataFrame:
    """df with _n, and with _block and _own: each key's rows in blocks of `rows`, a block also with the `halo` rows before it (_own is
    false for these). A window over (keys, _block) in the order of _n whose frame reaches back `halo` rows at most gives the rows
    with _own what a window over the keys would."""
    rows = max(rows, halo)
    n = numbered(df, keys, ts, order, step_s)
    block = F.floor((F.col("_n") - 1) / rows).cast("long")
    here = F.struct(block.alias("_block"), F.lit(True).alias("_own"))
    after = F.when((F.col("_n") - 1) % rows >= rows - halo, F.struct((block + 1).alias("_block"), F.lit(False).alias("_own")))
    out = n.withColumn("_x", F.explode(F.array_compact(F.array(here, after)))).select(*n.columns, "_x.*")
    # Windows over few bytes may take long: the number of partitions is given, so that adaptive execution doesn't put blocks together.
    return out.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_block")


def spans(df: DataFrame, ts: str, back_us: int, ahead_us: int, step_s: int = 86400, keys: tuple[str, ...] = ()) -> DataFrame:
    """df, dealt by keys (if any) and _span, with _us, its time in microseconds, and with _span and _own: rows in ranges of step_s seconds, a range also with the rows up to
    back_us before and ahead_us after it (_own is false for these). A window over (keys, _span) in the order of _us whose frame is a
    range within these bounds gives the rows with _own what a window over the keys would. Rows without a time have one range."""
    step = max(step_s * 1000000, back_us, ahead_us)
    at = lambda c: F.floor(c / F.lit(step)).cast("long")
    timed = df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    reached = F.when(F.col("_us").isNotNull(), F.sequence(at(F.col("_us") - ahead_us), at(F.col("_us") + back_us)))
    out = timed.withColumn("_span", F.explode_outer(reached)).withColumn("_own", F.col("_span").eqNullSafe(at(F.col("_us"))))
    return out.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_span")  # as in blocks()


def reached(keys: list[str], back_us: int, ahead_us: int) -> Column:
    """The number of the keys' rows from back_us before a row's _us to ahead_us after it, itself included; rows without _us are counted
    with each other, which takes keys that hold them apart, as _span does. It is the difference of two counts from the first row on, that
    each look at a row once; a frame that slides is counted anew for every row."""
    w = Window.partitionBy(*keys).orderBy("_us").rangeBetween
    before = F.when(F.col("_us").isNotNull(), F.count("*").over(w(Window.unboundedPreceding, -back_us - 1))).otherwise(0)
    return F.count("*").over(w(Window.unboundedPreceding, ahead_us)) - before
