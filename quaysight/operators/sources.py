"""Reconciliation of any number of sources at once (JOIN-05, REC-01, REC-02, REC-04, REC-06, UDF-04)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of fields whose mismatch weighs more, and machine epsilon as the tolerance takes it.
WEIGHTY = ("price", "amount", "balance", "quantity")
EPSILON = 2.22e-16


@dataclass(frozen=True)
class Tolerance:
    """When two values of a field are equal. decimal: numbers are compared as decimals of so many places, by `absolute` alone."""

    absolute: float = 1e-6
    relative: float = 1e-9
    ulps: float = 2
    epsilon: float = 1e-15
    decimal: int | None = None
    case_sensitive: bool = True


@dataclass
class Source:
    """Rows of a source. rename: own names of canonical fields; normalizers: what is made of a field before it is compared; order: columns
    by which the last of the rows of a key counts (else the largest row does)."""

    name: str
    rows: DataFrame
    priority: int = 0
    rename: dict[str, str] = field(default_factory=dict)
    normalizers: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    order: tuple[str, ...] = ()

    def canonical(self) -> DataFrame:
        """Rows in canonical names, normalised; a normaliser's null of a value that wasn't null leaves the value."""
        df = self.rows.withColumnsRenamed(self.rename)
        kept = lambda c, f: F.coalesce(f(F.col(c)), F.col(c))
        return df.withColumns({c: kept(c, f) for c, f in self.normalizers.items() if c in df.columns})


def same(a: Column, b: Column, kind: T.DataType, tolerance: Tolerance = Tolerance()) -> Column:
    """Whether two values of a type are equal (REC-01): nulls and NaNs equal each other; numbers within some units in the last place, a
    least difference, or an absolute or relative tolerance; texts with or without case; anything else exactly."""
    t = tolerance
    if isinstance(kind, T.StringType) and not t.case_sensitive:
        near = F.lower(a) == F.lower(b)
    elif isinstance(kind, T.NumericType) and t.decimal is not None:
        as_decimal = lambda x: x.cast("string").try_cast(T.DecimalType(38, t.decimal))
        near = F.coalesce(F.abs(as_decimal(a) - as_decimal(b)) <= F.lit(t.absolute), F.lit(False))
    elif isinstance(kind, T.NumericType):
        x, y = a.cast("double"), b.cast("double")
        apart, size = F.abs(x - y), F.greatest(F.abs(x), F.abs(y))
        # x - y of two equal infinities is NaN, which is larger than any number.
        near = (x == y) | (apart <= F.greatest(F.lit(t.epsilon), F.lit(t.absolute))) | (apart <= t.relative * size) & (size < float("inf")) | ((x != 0) & (y != 0) & (apart < t.ulps * EPSILON * size))
    else:
        near = a == b
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(near)


def all_pairs(sources: list[Source], keys: list[str], fields: list[str], times: tuple[str, ...] = (), drift_s: float = 1.0, tolerances: dict[str, Tolerance] | None = None, severities: dict[str, str] | None = None) -> DataFrame:
    """A row per discrepancy of each pair of sources: (keys, source_a, source_b, kind, field, value_a, value_b, severity, id).

    Kinds: missing_record (the source without the record has the priority, or an equal one), extra_record, value_mismatch, and
    timestamp_drift for the fields in times. Fields that one of the two sources lacks aren't compared. Of repeated keys in a source the
    last row counts; null keys are keys. id is that of the pair in either order. severities: overrides by field.
    All sources meet in one shuffle, in which a key has one row per source: rows are reduced to these before they are sent.
    """
    tolerances, severities = tolerances or {}, severities or {}
    if len({s.name for s in sources}) < len(sources):
        raise ValueError("sources must have names of their own")
    found, kinds = None, {}
    rows = [s.canonical() for s in sources]
    for df in rows:
        kinds |= {f.name: f.dataType for f in df.schema if f.name in fields and f.name not in kinds}
    for i, (s, df) in enumerate(zip(sources, rows)):
        row = F.struct(*[(F.col(f).cast(kinds[f]) if f in df.columns else F.lit(None).cast(kinds[f])).alias(f) for f in fields])
        rank = F.struct(*s.order, row) if s.order else row
        one = df.select(*keys, row.alias(f"_r{i}"), rank.alias(f"_o{i}"))
        found = one if found is None else found.unionByName(one, allowMissingColumns=True)
    by_key = found.groupBy(*keys).agg(*[F.max_by(f"_r{i}", f"_o{i}").alias(f"_{i}") for i in range(len(sources))])
    nothing = F.lit(None).cast("string")

    def finding(i, j, kind, name=None, severity="medium"):
        shown = [F.col(f"_{x}.{name}").cast("string") if name else nothing for x in (i, j)]
        return F.struct(F.lit(sources[i].name).alias("source_a"), F.lit(sources[j].name).alias("source_b"), F.lit(kind).alias("kind"), F.lit(name).cast("string").alias("field"), shown[0].alias("value_a"), shown[1].alias("value_b"), F.lit(severities.get(name, severity)).alias("severity"))

    every = []
    for i, j in combinations(range(len(sources)), 2):
        a, b = F.col(f"_{i}"), F.col(f"_{j}")
        for x, y, absent, there in ((i, j, a, b), (j, i, b, a)):
            first = sources[x].priority >= sources[y].priority
            every.append(F.when(absent.isNull() & there.isNotNull(), finding(i, j, "missing_record" if first else "extra_record", severity="high" if first else "medium")))
        for f in (f for f in fields if f in rows[i].columns and f in rows[j].columns):
            x, y = F.col(f"_{i}.{f}"), F.col(f"_{j}.{f}")
            if f in times:
                us = lambda c: F.unix_micros(c.cast("timestamp"))
                bad = ~F.coalesce(F.abs(us(x) - us(y)) <= drift_s * 1e6, x.isNull() & y.isNull())
                what = finding(i, j, "timestamp_drift", f, "low")
            else:
                bad = ~same(x, y, kinds[f], tolerances.get(f, Tolerance()))
                what = finding(i, j, "value_mismatch", f, "high" if any(w in f.lower() for w in WEIGHTY) else "medium")
            every.append(F.when(a.isNotNull() & b.isNotNull() & bad, what))
    out = by_key.select(*keys, F.explode(F.array_compact(F.array(*every))).alias("_d")).select(*keys, "_d.*")
    pair = F.concat_ws("|", F.least("source_a", "source_b"), F.greatest("source_a", "source_b"), F.to_json(F.struct(*sorted(keys))), F.coalesce("field", F.when(F.col("kind") == "missing_record", "missing").otherwise("extra")))
    return out.withColumn("id", F.concat(F.lit("disc_"), F.substring(F.sha2(pair, 256), 1, 16)))
