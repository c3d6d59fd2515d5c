"""From landed rows to typed ones, and the schemas of the usual tables (PRJ-01, PRJ-02, PRJ-26, VAL-02, VAL-03, VAL-22 to VAL-35)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import decimal_or_null, epoch_us
from .validate import Field, Rule, Schema

TRUE, FALSE = ("true", "1", "yes", "y", "on"), ("false", "0", "no", "n", "off")


def coerced(text: Column, kind: str) -> Column:
    """struct(value, state) of a text as another type: state is null for a missing value, ok, type_coerced where the text isn't how
    the value is written, type_mismatch where there is none (VAL-03). kind: bigint, double, decimal(..), boolean, timestamp_us."""
    clean = F.trim(text)
    if kind == "boolean":
        low = F.lower(clean)
        value = F.when(low.isin(*TRUE), True).when(low.isin(*FALSE), False)
        plain = clean.isin("true", "false")
    elif kind == "timestamp_us":
        value = epoch_us(F.when(clean.rlike(r"^[0-9]{1,18}$"), clean).try_cast("bigint"), "validator")
        plain = clean.rlike(r"^[0-9]{16}$")
    else:
        pattern = r"^[+-]?[0-9]+$" if kind == "bigint" else r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
        value = F.when(clean.rlike(pattern), clean.try_cast(kind))
        plain = value.cast("string") == text
    state = F.when(text.isNull(), None).when(value.isNull(), "type_mismatch").when(plain & (clean == text), "ok").otherwise("type_coerced")
    return F.struct(value.alias("value"), state.alias("state"))


def parsed_trades(raw: DataFrame) -> DataFrame:
    """Trades of landed text columns: the time is timestamp_utc_us or else timestamp, numbers that don't parse are null, and error
    says what is missing (PRJ-01, PRJ-02)."""
    ts = F.coalesce(F.col("timestamp_utc_us").try_cast("bigint"), F.col("timestamp").try_cast("bigint"))
    price, quantity = (decimal_or_null(F.col(c), "decimal(18,8)") for c in ("price", "quantity"))
    error = F.when(ts.isNull(), "no_time").when(price.isNull(), "bad_price").when(quantity.isNull(), "bad_quantity")
    return raw.select("trade_id", epoch_us(ts).alias("ts_us"), price.alias("price"), quantity.alias("quantity"), error.alias("error"))


def renamed(df: DataFrame, names: dict[str, str], normalisers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """df with columns renamed and then normalised each by its function (PRJ-26)."""
    out = df.withColumnsRenamed(names)
    return out.withColumns({c: f(F.col(c)) for c, f in normalisers.items()}) if normalisers else out


def unexpected(payload: Column, known: list[str]) -> Column:
    """The keys of a JSON object that a schema doesn't have (VAL-02)."""
    return F.array_sort(F.array_except(F.json_object_keys(payload), F.array(*[F.lit(k) for k in known])))


def times_rules(name: str, fields: list[str], as_of: Column, future_s: int = 300) -> tuple[Rule, ...]:
    """Times ahead of now, repeated among the fields, or of mixed precision, seconds told first (VAL-22, VAL-23)."""
    us = lambda: F.filter(F.array(*[F.unix_micros(F.col(f).cast("timestamp")) for f in fields]), lambda t: t.isNotNull())
    grain = lambda t: F.when(t % 1000000 == 0, 0).when(t % 1000 == 0, 1).otherwise(2)
    return (
        Rule("future", name, lambda: F.exists(us(), lambda t: t > F.unix_micros(as_of.cast("timestamp")) + future_s * 1000000)),
        Rule("repeated_time", name, lambda: F.size(F.array_distinct(us())) < F.size(us()), "warning"),
        Rule("mixed_precision", name, lambda: F.size(F.array_distinct(F.transform(us(), grain))) > 1, "warning"),
    )


def weekend(name: str, ts: str) -> Rule:
    return Rule("weekend", name, lambda: F.weekday(F.col(ts)) >= 5, "warning")


def near(name: str, ts: str, as_of: Column, hours: int = 24) -> Rule:
    """A time within the hours of now."""
    return Rule("implausible_time", name, lambda: F.abs(F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(as_of.cast("timestamp"))) > hours * 3600 * 1000000)


def trade_schema(as_of: Column, hours: int = 24) -> Schema:
    """VAL-30, VAL-31, VAL-35."""
    return Schema("exchange_trades", (Field("venue", required=True), Field("symbol", required=True), Field("price", required=True, low=1e-12, high=1e7), Field("quantity", required=True, low=1e-12), Field("side", allowed=("buy", "sell"), ignore_case=True)), ("trade_id",), (near("ts", "ts", as_of, hours),))


def option_schema() -> Schema:
    """VAL-32."""
    return Schema("options_surface", (Field("strike", required=True, low=1e-12), Field("iv", low=0, high=10), Field("delta", low=-1, high=1), Field("gamma", low=0), Field("option_type", allowed=("call", "put"))), ("symbol", "expiry"))


def flow_schema(latest_block: int, decimals: int = 18) -> Schema:
    """VAL-33."""
    hex_ = lambda n: f"0x[0-9a-fA-F]{{{n}}}"
    return Schema("onchain_flows", (Field("from_address", pattern=hex_(40)), Field("to_address", pattern=hex_(40)), Field("tx_hash", required=True, pattern=hex_(64)), Field("amount", low=0, high=10.0 ** (decimals + 12)), Field("block_number", high=latest_block + 100)), ("chain",))


def calendar_schema(as_of: str) -> Schema:
    """VAL-34: starts from five years back to ten ahead, ends not before the start, titles and ids long enough."""
    year = int(as_of[:4])
    return Schema("calendar", (Field("start", required=True, after=f"{year - 5}{as_of[4:]}", before=f"{year + 10}{as_of[4:]}"), Field("title", required=True, min_length=10), Field("event_id", required=True, min_length=8)), (), (Rule("wrong_order", "end", lambda: F.col("end") < F.col("start")),))


def analysed(df: DataFrame, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), skip: tuple[str, ...] = ("id", "hash", "address", "signature")) -> list[str]:
    """Columns worth an analysis, chosen when the plan is made (VAL-40): the included ones, else all that aren't excluded and whose
    names don't speak of identities."""
    return [c for c in df.columns if (c in include if include else c not in exclude and not any(w in c.lower().split("_") for w in skip))]


def schema_difference(a: DataFrame, b: DataFrame) -> list[tuple[str, str, str]]:
    """(column, type in a, type in b) where two sources differ; an absent column has an empty type (REC-03)."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return [(c, x.get(c, ""), y.get(c, "")) for c in sorted(set(x) | set(y)) if x.get(c) != y.get(c)]


def symmetric_id(source_a: str, source_b: str, key: Column) -> Column:
    """An identity of a discrepancy that doesn't depend on the order of the sources (REC-07)."""
    return F.substring(F.sha2(F.concat_ws("|", F.lit("|".join(sorted((source_a, source_b)))), key.cast("string")), 256), 1, 16)


def delayed(df: DataFrame, arrival: str, ts: str, minutes: int = 5) -> DataFrame:
    """Rows that arrived more than the minutes after their time (REC-10)."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return df.where(us(arrival) - us(ts) > minutes * 60 * 1000000)


def aligned(a: DataFrame, b: DataFrame, key: str | None) -> DataFrame:
    """Rows of two frames side by side by a key (JOIN-02). Frames have no order, so that a key is required."""
    if not key:
        raise ValueError("DataFrames have no row order: name a key column to align by")
    return a.join(b, key)
