"""Audit rows of transformations by observation: counts and checks come from the run that writes, without a second pass (AGG-44)."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SCHEMA = "transformation string, rows_in long, rows_out long, rows_lost long, checks map<string,long>, first timestamp, last timestamp, seconds double, within_sla boolean, at timestamp, error string"


def audited(name: str, rows: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, ts: str, checks: dict[str, Column] | None = None, sla_s: float | None = None) -> DataFrame:
    """Writes transform(rows) to path as Parquet and returns its audit row; it is appended to `<path>-audit`, which a failed run is too, with
    its error, before the error is raised.

    rows_in and rows_out are counted as the rows pass, checks count the rows out for which a condition holds, first and last are the
    edges of the time column in what is written. Nothing is read twice, also where the input is a query. An empty input has zeros
    and no times. within_sla is null without a limit.
    """
    spark, checks = rows.sparkSession, checks or {}
    seen, made = Observation(), Observation()
    began, error = time.time(), None
    try:
        out = transform(rows.observe(seen, F.count(F.lit(1)).alias("n")))
        at = F.col(ts).cast("timestamp")
        sums = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"check_{i}") for i, c in enumerate(checks.values())]
        out.observe(made, F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last"), *sums).write.mode("overwrite").parquet(path)
        a, b = seen.get, made.get
        row = (name, a["n"], b["n"], a["n"] - b["n"], {k: b[f"check_{i}"] for i, k in enumerate(checks)}, b["first"], b["last"])
    except Exception as e:  # noqa: BLE001  the audit tells of any failure
        error = e
        row = (name, None, None, None, {}, None, None)
    took = time.time() - began
    audit = spark.createDataFrame([(*row, took, None if sla_s is None else error is None and took <= sla_s, None, str(error)[:500] if error else None)], SCHEMA).withColumn("at", F.current_timestamp())
    audit.coalesce(1).write.mode("append").parquet(f"{path}-audit")
    if error:
        raise error
    return audit
