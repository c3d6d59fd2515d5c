"""Incident, telemetry and service-level analytics (AGG-28 to AGG-48, JOIN-11, JOIN-14, STR-06)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import reached, spans


def rate(incidents: DataFrame, unit: str) -> DataFrame:
    """Incidents per time unit and class, by severity (AGG-28, AGG-31)."""
    of = lambda s: F.count_if(F.col("severity") == s)
    return incidents.groupBy(F.date_trunc(unit, "ts").alias("bucket"), "incident_class").agg(F.count("*").alias("n"), of("crit").alias("crit"), of("warn").alias("warn"))


def partials(df: DataFrame, keys: list[str], value: str, unit: str) -> DataFrame:
    """Mergeable sums and counts per time unit (AGG-29); merge them with merged()."""
    return df.groupBy(F.date_trunc(unit, "ts").alias("bucket"), *keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg((F.sum("total") / F.sum("n")).alias("mean"), F.sum("n").alias("n"))


def summary(incidents: DataFrame) -> DataFrame:
    """By class, severity and agent: number, resolved and mean value (AGG-32)."""
    return incidents.groupBy("incident_class", "severity", "agent").agg(F.count("*").alias("n"), F.count_if("resolved").alias("resolved"), F.avg("value").alias("mean_value"))


def execution_metrics(executions: DataFrame, venue: str | None = None, symbol: int | None = None) -> DataFrame:
    """By venue and symbol: orders, mean slippage and queue, volume, fees and rejects (AGG-33)."""
    e = executions if venue is None else executions.where(F.col("venue") == venue)
    e = e if symbol is None else e.where(F.col("symbol") == symbol)
    return e.groupBy("venue", "symbol").agg(
        F.count("*").alias("orders"), F.avg("slippage").alias("mean_slippage"), F.avg("queue").alias("mean_queue"), F.sum(F.col("quantity") * F.col("price")).alias("volume"), F.sum("fee").alias("fees"), F.count_if("rejected").alias("rejects"),
    )


def metrics(df: DataFrame, kinds: list[str], since: Column) -> DataFrame:
    """Mean, largest, smallest and number by kind and entity since a time (AGG-34)."""
    return df.where(F.col("kind").isin(*kinds) & (F.col("ts") >= since)).groupBy("kind", "entity").agg(F.avg("value").alias("mean"), F.max("value").alias("largest"), F.min("value").alias("smallest"), F.count("*").alias("n"))


def latest_state(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """The newest values of each key (AGG-35)."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.struct(*order)).alias(c) for c in columns], F.max("ts").alias("last_ts"))


def spikes(incidents: DataFrame, seconds: int, least: int) -> DataFrame:
    """Incidents with at least so many of their class and agent in the trailing seconds (AGG-36)."""
    back = seconds * 1000000
    return spans(incidents, "ts", back, 0, keys=("incident_class", "agent")).withColumn("recent", reached(["incident_class", "agent", "_span"], back, 0)).where(F.col("_own") & (F.col("recent") >= least)).drop("_us", "_span", "_own")


def cascades(incidents: DataFrame, length: str, slide: str, agents: int, each: int) -> DataFrame:
    """Sliding windows in which at least so many agents have at least so many incidents each (AGG-37)."""
    per = incidents.groupBy(F.window("ts", length, slide).alias("w"), "agent").agg(F.count("*").alias("n")).where(F.col("n") >= each)
    return per.groupBy("w").agg(F.count("*").alias("agents"), F.sum("n").alias("incidents")).where(F.col("agents") >= agents).select(F.col("w.start").alias("start"), "agents", "incidents")


def breaches(df: DataFrame, breach: Column, least: int) -> DataFrame:
    """Days and classes with at least so many breaches (AGG-38)."""
    return df.groupBy(F.to_date("ts").alias("day"), "incident_class").agg(F.count_if(breach).alias("breaches"), F.count("*").alias("n")).where(F.col("breaches") >= least)


def latency(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """p50, p95 and p99 as the element int(n * q) of the sorted values, nulls first (AGG-41)."""
    place = lambda q: lambda n: F.floor(n * q)
    return elements(df, keys, value, {"p50": place(0.5), "p95": place(0.95), "p99": place(0.99)})


def elements(df: DataFrame, keys: list[str], value: str, places: dict[str, Callable[[Column], Column]], buckets: int = 64) -> DataFrame:
    """Per key the number n of its rows and elements of the sorted values, nulls first, at places (from 0) that depend on n. A key's values
    are dealt to quantile buckets, which are counted; only those that hold such an element are sorted, equal values as one, so that
    no key is gathered. Null keys are one key."""
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).alias("_v"))
    edges = rows.groupBy(*names).agg(F.percentile_approx("_v", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), 10000).alias("_e"))

    def joined(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        other = b.withColumnsRenamed({n: f"{n}_r" for n in on})
        return a.join(other, [a[n].eqNullSafe(other[f"{n}_r"]) for n in on]).drop(*[f"{n}_r" for n in on])

    bucket = F.coalesce(F.size(F.filter("_e", lambda x: x < F.col("_v"))), F.lit(0))
    counts = joined(rows, edges, names).withColumn("_b", bucket).groupBy(*names, "_b", "_v").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*names)  # a row per bucket
    sizes = counts.groupBy(*names, "_b").agg(F.sum("_c").alias("_s")).withColumn("_n", F.sum("_s").over(whole))
    sizes = sizes.withColumn("_before", F.sum("_s").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_s"))
    holds = lambda at, start, size: (at(F.col("_n")) >= start) & (at(F.col("_n")) < start + size)
    wanted = sizes.where(reduce(or_, [holds(at, F.col("_before"), F.col("_s")) for at in places.values()]))
    here = joined(counts, wanted, [*names, "_b"])
    start = F.col("_before") + F.sum("_c").over(Window.partitionBy(*names, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
    found = here.withColumn("_start", start).groupBy(*names).agg(
        *[F.max(F.when(holds(at, F.col("_start"), F.col("_c")), F.col("_v"))).alias(p) for p, at in places.items()], F.max("_n").alias("n"),
    )
    return found.withColumnsRenamed(dict(zip(names, keys)))


def root_causes(incidents: DataFrame, minutes: int = 30, most: int = 50, step_s: int = 86400) -> DataFrame:
    """Per incident its neighbours of the same agent within the minutes: number (of the nearest `most`), and whether it stands alone
    or in a burst of more than five (JOIN-11). Counted over a range of times, without a self-join, by ranges of step_s seconds or the
    minutes, whichever is longer; rows without a time are neighbours of each other."""
    reach = minutes * 60 * 1000000
    found = spans(incidents, "ts", reach, reach, step_s, ("agent",)).withColumn("_near", reached(["agent", "_span"], reach, reach) - 1).where("_own")
    near = F.col("_near")
    return found.withColumn("related", F.least(near, F.lit(most))).withColumn("isolated", near == 0).withColumn("burst", near > 5).drop("_near", "_us", "_span", "_own")


def related_ids(incidents: DataFrame, minutes: int = 30, most: int = 50, step_s: int = 86400, run: int = 64) -> DataFrame:
    """incidents with related, the ids of the first `most` other incidents of the same agent within the minutes, in order of (ts,
    incident_id), and related_count, the number of all (JOIN-11). Rows without a time have none.

    In the order of a range of times the wanted ids stand together, from the first row in reach on. So rows are numbered, `run` of them
    make one row of a list, which also holds the next list's, and an incident is joined with the list that its ids begin in: no row ever
    holds more than these, and none that is sorted but the lists holds any.
    """
    reach, run = minutes * 60 * 1000000, max(run, most + 1)
    part = Window.partitionBy("agent", "_span")
    timed = spans(incidents.where("ts IS NOT NULL"), "ts", reach, reach, step_s, ("agent",))
    timed = timed.withColumn("_n", F.row_number().over(part.orderBy("_us", "incident_id")) - 1)
    lists = timed.groupBy("agent", "_span", F.floor(F.col("_n") / run).alias("_list")).agg(F.array_sort(F.collect_list(F.struct("_n", "incident_id")))["incident_id"].alias("_ids"))
    after = F.coalesce(F.lead("_ids").over(part.orderBy("_list")), F.array().cast(lists.schema["_ids"].dataType))
    lists = lists.select(F.col("agent").alias("_agent"), F.col("_span").alias("_s"), F.col("_list").alias("_l"), F.concat("_ids", after).alias("_ids"))
    from_ = F.count("*").over(part.orderBy("_us").rangeBetween(Window.unboundedPreceding, -reach - 1))
    own = timed.withColumn("_from", from_).withColumn("_near", reached(["agent", "_span"], reach, reach)).where("_own")
    here = F.col("agent").eqNullSafe(F.col("_agent")) & (F.col("_span") == F.col("_s")) & (F.floor(F.col("_from") / run) == F.col("_l"))
    near = F.slice("_ids", (F.col("_from") % run + 1).cast("int"), F.least(F.col("_near"), F.lit(most + 1)).cast("int"))
    found = own.join(lists, here).withColumn("related", F.slice(F.filter(near, lambda x: x != F.col("incident_id")), 1, most))
    found = found.select(*incidents.columns, "related", (F.col("_near") - 1).alias("related_count"))
    timeless = incidents.where("ts IS NULL").withColumn("related", F.array().cast(found.schema["related"].dataType)).withColumn("related_count", F.lit(0).cast("long"))
    return found.unionByName(timeless)


def first_of_batch(incidents: DataFrame, keys: list[str]) -> DataFrame:
    """The first incident of each identity with the number of repeats (JOIN-14)."""
    return incidents.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in incidents.columns if c not in keys]), F.struct("ts", "incident_id")).alias("_r"), F.count("*").alias("repeats")).select(*keys, "_r.*", "repeats")


def suppressed(incidents: DataFrame, keys: list[str], ttl_s: float) -> DataFrame:
    """Greedy suppression (STR-06): an incident is emitted if its key has emitted none within the seconds before; `repeats` counts
    those held back since. The greedy choice depends on what was emitted, so that each key is walked once in time order; rows of a
    key are streamed in batches, never gathered."""
    ttl = int(ttl_s * 1000000)
    names = [f"k{i}" for i in range(len(keys))]
    rows = incidents.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "incident_id")
    rows = rows.repartition(*names).sortWithinPartitions(*names, "us", "incident_id")

    def walk(batches):
        import pyarrow as pa

        key, last, held, first = None, 0, 0, None
        for batch in batches:
            out = []
            for *k, us, i in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key or us - last >= ttl:
                    if first is not None:
                        out.append((*first, held))
                    key, last, held, first = k, us, 0, (*k, us, i)
                else:
                    held += 1
            yield pa.RecordBatch.from_pylist([dict(zip([*names, "us", "incident_id", "repeats"], r)) for r in out], schema=pa.schema([*[(n, t) for n, t in zip(names, batch.schema.types)], ("us", pa.int64()), ("incident_id", pa.int64()), ("repeats", pa.int64())]))
            types = batch.schema.types
        if first is not None:
            yield pa.RecordBatch.from_pylist([dict(zip([*names, "us", "incident_id", "repeats"], (*first, held)))], schema=pa.schema([*[(n, t) for n, t in zip(names, types)], ("us", pa.int64()), ("incident_id", pa.int64()), ("repeats", pa.int64())]))

    kinds = dict(incidents.dtypes)
    schema = ", ".join([*(f"{n} {kinds[k]}" for k, n in zip(keys, names)), "us long, incident_id long, repeats long"])
    return rows.mapInArrow(walk, schema).select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "us", "incident_id", "repeats")


def resolution(incidents: DataFrame, resolved_at: str) -> DataFrame:
    """By class and severity: number, resolved and the mean seconds from an incident to its resolution (AGG-32); open ones don't count."""
    seconds = (F.unix_micros(F.col(resolved_at).cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1000000
    return incidents.groupBy("incident_class", "severity").agg(F.count("*").alias("n"), F.count(resolved_at).alias("resolved"), F.avg(seconds).alias("mean_resolution_s"))
