"""Identity and content hashes (PRJ-19 to PRJ-25, SRC-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_hash(*parts: Column) -> Column:
    """SHA-256 of the parts that aren't null, joined by colons."""
    return F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)


def levels_hash(seq: Column, bids: Column, asks: Column, depth: int = 5) -> Column:
    """Hash of a book: its sequence and the first levels of both sides."""
    text = lambda side: F.array_join(F.transform(F.slice(side, 1, depth), lambda x: F.concat_ws("@", x["price"].cast("string"), x["quantity"].cast("string"))), ",")
    return F.sha2(F.concat_ws(":", seq.cast("string"), text(bids), text(asks)), 256)


def row_hash(df: DataFrame, keys: list[str] | None = None, leave_out: tuple[str, ...] = ("ts", "timestamp", "timestamp_utc_us", "capture_timestamp", "ingest_ts")) -> Column:
    """MD5 of name=value pairs in name order; floats in ten significant digits. Without keys, all columns but the times."""
    names = sorted(keys or [c for c in df.columns if c not in leave_out])
    kinds = dict(df.dtypes)
    show = lambda c: F.format_string("%.9e", F.col(c)) if kinds[c] in ("double", "float") else F.col(c).cast("string")
    return F.md5(F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(show(c), F.lit("null"))) for c in names]))


def row_identifier(keys: list[str]) -> Column:
    """The key parts joined by colons; where one is null, the first 16 digits of an MD5 of them all."""
    whole = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    whole_null = F.lit(False)
    for k in keys:
        whole_null = whole_null | F.col(k).isNull()
    return F.when(whole_null, F.substring(F.md5(F.concat_ws("|", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in sorted(keys)])), 1, 16)).otherwise(whole)


def payload_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the JSON of the columns in name order."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def luhn(text: Column) -> Column:
    return F.expr("luhn_check(s)") if isinstance(text, str) else F.call_function("luhn_check", text)


def iban(text: Column) -> Column:
    """Whether the letters and digits of an IBAN give 1 modulo 97, folded digit by digit."""
    clean = F.upper(F.regexp_replace(text, r"\s", ""))
    moved = F.concat(F.substring(clean, 5, 64), F.substring(clean, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), lambda s, c: (F.when(value(c) > 9, s * 100).otherwise(s * 10) + value(c)) % 97)
    return clean.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}$") & (rest == 1)


def isbn(text: Column) -> Column:
    """Whether the check digit of an ISBN-10 or ISBN-13 holds."""
    clean = F.upper(F.regexp_replace(text, "[- ]", ""))
    chars = F.filter(F.split(clean, ""), lambda c: c != "")
    digit = lambda c: F.when(c == "X", 10).otherwise(F.ascii(c) - 48)
    weighted = lambda w: F.aggregate(F.transform(chars, lambda c, i: digit(c) * w(i)), F.lit(0), lambda s, x: s + x)
    ten = clean.rlike("^[0-9]{9}[0-9X]$") & (weighted(lambda i: 10 - i) % 11 == 0)
    thirteen = clean.rlike("^[0-9]{13}$") & (weighted(lambda i: F.when(i % 2 == 0, 1).otherwise(3)) % 10 == 0)
    return ten | thirteen


def content_hash(identity: list[Column], **values: Column) -> Column:
    """SHA-256 of the identity's parts and then name=value of what is set: it changes with the values, joined_hash(*identity) doesn't
    (PRJ-20)."""
    named = [F.concat(F.lit(f"{name}="), v.cast("string")) for name, v in values.items()]
    return joined_hash(*identity, *named)


def flow_hash(chain: Column, kind: Column, tx: Column, index: Column, ends: tuple[Column, Column], token: Column, amount: Column, decimals: Column) -> Column:
    """Identity of a transfer (PRJ-21): by its index in the transaction, else by addresses, token and the amount quantised half even to
    the token's decimals (18 if unknown). Null parts are empty, a null or zero amount is 0."""
    text = F.lit(None).cast("string")
    d = F.when(decimals.between(0, 18), decimals).otherwise(18)
    for k in range(19):
        text = F.when(d == k, F.bround(amount, k).cast(f"decimal(38,{k})").cast("string")).otherwise(text)
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    parts = F.concat_ws(":", *map(low, ends), low(token), F.when(F.coalesce(amount, F.lit(0)) == 0, "0").otherwise(text))
    return F.sha2(F.concat_ws(":", chain, kind, tx, F.coalesce(index.cast("string"), parts)), 256)


def window_hash(source: Column, us: Column, total: Column, window_s: int = 300) -> Column:
    """Identity of a metric within a window of seconds (PRJ-22): its source, the window's start and the total in whole units."""
    step = window_s * 1000000
    return joined_hash(source, F.floor(us / step).cast("bigint") * step, F.bround(total, 0).cast("bigint"))
