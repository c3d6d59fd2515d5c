"""Declarative validation (VAL, QLT-06 to QLT-09, AGG-45): rules are data that compile to one Column, an array of violations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import blocks, lagged


@dataclass(frozen=True)
class Rule:
    """A row violates the rule where `bad` is true; null is no violation."""

    kind: str
    name: str
    bad: Callable[[], Column]
    severity: str = "error"


#: What a text of each kind looks like; of a phone number only digits and plus signs count.
SEMANTICS = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "url": r"https?://[^\s/$.?#].[^\s]*",
    "phone": r"\+?[1-9][0-9]{1,14}",
    "country_code": r"[A-Z]{2}",
    "currency_code": r"[A-Z]{3}",
}


def semantic(text: Column, kind: str) -> Column:
    """Whether a text is an e-mail address, URL, phone number, country code or currency code (VAL-15); null of null."""
    return (F.regexp_replace(text, "[^0-9+]", "") if kind == "phone" else text).rlike(f"^(?:{SEMANTICS[kind]})$")


@dataclass(frozen=True)
class Field:
    """What a column must be. Only what is set is checked."""

    name: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    scale: int | None = None
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    allowed: tuple = ()
    ignore_case: bool = False
    after: str | None = None
    before: str | None = None
    business_hours: bool = False
    item_low: float | None = None
    item_kind: str | None = None
    key_pattern: str | None = None
    value_kind: str | None = None
    semantic: str | None = None
    custom: Callable[[Column], Column] | None = None

    def rules(self) -> list[Rule]:
        c = lambda: F.col(self.name)
        out = []
        add = lambda kind, bad, severity="error": out.append(Rule(kind, self.name, bad, severity))
        if self.required:
            add("missing", lambda: c().isNull())
        if self.low is not None:
            add("below_minimum", lambda: c() < self.low)
        if self.high is not None:
            add("above_maximum", lambda: c() > self.high)
        if self.scale is not None:
            add("scale_coerced", lambda: F.abs(F.bround(c(), self.scale) - c()) > 10 ** -(self.scale + 6), "warning")
        if self.min_length is not None:
            add("too_short", lambda: F.length(c()) < self.min_length)
        if self.max_length is not None:
            add("too_long", lambda: F.length(c()) > self.max_length)
        if self.pattern is not None:
            add("pattern_mismatch", lambda: ~c().rlike(f"^(?:{self.pattern})$"))
        if self.allowed:
            value = (lambda: F.lower(c())) if self.ignore_case else c
            add("not_allowed", lambda: ~value().isin(*[a.lower() if self.ignore_case else a for a in self.allowed]))
        if self.after is not None:
            add("too_early", lambda: c() < F.lit(self.after).cast("timestamp_ntz"))
        if self.before is not None:
            add("too_late", lambda: c() > F.lit(self.before).cast("timestamp_ntz"))
        if self.business_hours:
            add("outside_business_hours", lambda: (F.weekday(c()) >= 5) | ~F.hour(c()).between(9, 16), "warning")
        if self.item_low is not None:
            add("item_below_minimum", lambda: F.exists(c(), lambda x: x < self.item_low))
        if self.item_kind is not None:
            add("item_mismatch", lambda: F.exists(c(), lambda x: x.isNotNull() & x.try_cast(self.item_kind).isNull()))
        if self.value_kind is not None:
            add("value_mismatch", lambda: F.exists(F.map_values(c()), lambda x: x.isNotNull() & x.try_cast(self.value_kind).isNull()))
        if self.semantic is not None:
            add("semantic_mismatch", lambda: ~semantic(c(), self.semantic))
        if self.key_pattern is not None:
            add("key_mismatch", lambda: F.exists(F.map_keys(c()), lambda k: ~k.rlike(f"^(?:{self.key_pattern})$")))
        if self.custom is not None:
            add("custom", lambda: ~self.custom(c()))
        return out


@dataclass(frozen=True)
class Schema:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = field(default=())

    def all_rules(self) -> list[Rule]:
        found = [r for f in self.fields for r in f.rules()]
        keys = [Rule("key_missing", k, lambda k=k: F.col(k).isNull()) for k in self.key]
        return [*found, *keys, *self.rules]


def conditional(name: str, when: Callable[[], Column], fields: list[str]) -> Rule:
    """Fields that must be set where a condition holds (VAL-17)."""
    return Rule("conditional_missing", name, lambda: when() & F.array_contains(F.array(*[F.col(f).isNull() for f in fields]), True))


def exclusive(name: str, fields: list[str]) -> Rule:
    """Exactly one of the fields is set (VAL-18)."""
    return Rule("not_exclusive", name, lambda: sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0)) != 1)


def ordered(name: str, fields: list[str]) -> Rule:
    """Times that follow each other; nulls are skipped (VAL-20)."""
    times = lambda: F.filter(F.array(*[F.col(f) for f in fields]), lambda t: t.isNotNull())
    return Rule("wrong_order", name, lambda: F.exists(F.zip_with(F.slice(times(), 1, F.greatest(F.size(times()) - 1, F.lit(0))), F.slice(times(), 2, F.greatest(F.size(times()) - 1, F.lit(0))), lambda a, b: a > b), lambda x: x))


def gap(name: str, first: str, second: str, most_s: float) -> Rule:
    """The second time at most so many seconds behind the first (VAL-21)."""
    seconds = lambda: (F.unix_micros(F.col(second).cast("timestamp")) - F.unix_micros(F.col(first).cast("timestamp"))) / 1000000
    return Rule("gap_too_long", name, lambda: seconds() > most_s, "warning")


def violations(df: DataFrame, schema: Schema) -> DataFrame:
    """df with `violations` array<struct<kind, field, severity>>: all rules in one projection."""
    each = [F.when(r.bad(), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.name).alias("field"), F.lit(r.severity).alias("severity"))) for r in schema.all_rules()]
    return df.withColumn("violations", F.array_compact(F.array(*each)))


def passes(strict: bool = False) -> Column:
    """Whether a row's violations let it through: none at all, or no error."""
    return F.size("violations") == 0 if strict else ~F.exists("violations", lambda v: v["severity"] == "error")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their reason), of a frame with violations (QLT-04, SRC-04)."""
    reason = F.array_join(F.transform("violations", lambda v: F.concat_ws(":", v["kind"], v["field"])), ",")
    return df.where(passes()).drop("violations"), df.where(~passes()).withColumn("reason", reason)


def summary(df: DataFrame, id_col: str) -> DataFrame:
    """Per kind and field: rows violating and the first of them (AGG-45)."""
    v = df.select(id_col, F.explode("violations").alias("v"))
    return v.groupBy("v.kind", "v.field").agg(F.count("*").alias("violations"), F.min(id_col).alias("first_row"))


def top_fields(df: DataFrame, most: int = 10) -> DataFrame:
    """The `most` fields with most violations, ties by name (AGG-45)."""
    found = df.select(F.explode("violations").alias("v")).where("v.field IS NOT NULL").groupBy("v.field").agg(F.count("*").alias("violations"), F.count_distinct("v.kind").alias("kinds"))
    return found.orderBy(F.desc("violations"), "field").limit(most)


def totals(df: DataFrame) -> DataFrame:
    n, ok = F.count("*"), F.sum(passes().cast("long"))
    return df.agg(n.alias("rows"), ok.alias("passed"), F.round(ok / n, 6).alias("pass_rate"))


def did_you_mean(values: DataFrame, valid: DataFrame, least: float = 0.85, most: int = 3) -> DataFrame:
    """(value, valid, similarity): for each value the `most` valid ones of a similarity of at least `least`, 1 - edits / longer length
    (JOIN-13). values has value, valid has valid; equal ones aren't proposed. Empty and null texts have no proposals.

    Texts one edit apart share a text from which one character at most is left out: such texts are joined, which takes rows in proportion
    to the characters, whatever texts have in common. One edit is nearer than two or more, so that values with `most` of these are
    done. The others are met by pieces: of a valid text that is cut into one piece more than edits are allowed, one piece stays
    whole within as many places.
    """
    goods = valid.select("valid").where("length(valid) > 0").distinct()
    asked = values.select("value").where("length(value) > 0").distinct()
    rated = F.round(1 - F.levenshtein("value", "valid") / F.greatest(F.length("value"), F.length("valid")), 6)
    without = lambda c: F.array_distinct(F.concat(F.array(F.col(c)), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(F.col(c), i + 1, F.length(c))))))
    close = asked.select("value", F.explode(without("value")).alias("k")).join(goods.select("valid", F.explode(without("valid")).alias("k")), "k").where("value != valid AND levenshtein(value, valid) = 1")
    close = close.select("value", "valid").distinct().withColumn("similarity", rated).where(F.col("similarity") >= least)
    w = Window.partitionBy("value").orderBy(F.desc("similarity"), "valid")
    first = close.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).drop("k")
    done = first.groupBy("value").count().where(F.col("count") >= most).select("value")
    far = _by_pieces(asked.join(done, "value", "left_anti"), goods, least).withColumn("similarity", rated).where(F.col("similarity") >= least)
    return first.join(done, "value", "left_semi").unionByName(far.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).drop("k"))


def _by_pieces(values: DataFrame, valid: DataFrame, least: float) -> DataFrame:
    """(value, valid) that share a piece near its place, among them all pairs of a similarity of at least `least`."""
    edits = lambda n: F.floor((1 - least) / least * n + 1e-9).cast("int")  # noqa: E731  a text of n characters and one of n / least at most
    start = lambda n, i: F.floor(i * n / (edits(n) + 1)).cast("int")
    piece = lambda text, n, i, at: F.struct(n.alias("n"), i.alias("i"), F.substring(text, at + 1, start(n, i + 1) - start(n, i)).alias("piece"))
    right = valid.withColumn("n", F.length("valid"))
    right = right.select("valid", F.explode(F.transform(F.sequence(F.lit(0), edits(F.col("n"))), lambda i: piece(F.col("valid"), F.col("n"), i, start(F.col("n"), i)))).alias("k"))
    m = F.length("value")
    around = lambda n, i: F.sequence(F.greatest(F.lit(0), start(n, i) - edits(n)), start(n, i) + edits(n))
    of_length = lambda n: F.flatten(F.transform(F.sequence(F.lit(0), edits(n)), lambda i: F.transform(around(n, i), lambda at: piece(F.col("value"), n, i, at))))
    lengths = F.sequence(F.ceil(m * least - 1e-9).cast("int"), F.floor(m / least + 1e-9).cast("int"))
    left = values.select("value", F.explode(F.array_distinct(F.flatten(F.transform(lengths, of_length)))).alias("k"))
    return left.join(right, "k").where("value != valid").select("value", "valid").distinct()


def duplicates(df: DataFrame, keys: list[str], order: list[str], id_col: str) -> DataFrame:
    """Second and later rows of a key, with the first row's id; rows with a null key part are skipped (QLT-06)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    out = df.where(whole).withColumn("occurrence", F.row_number().over(w)).withColumn("first_id", F.first(id_col).over(w))
    return out.where("occurrence > 1")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key (SRC-12)."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_r")).select("_r.*")


def sums_to_zero(df: DataFrame, group: list[str], amount: str, tolerance: float = 0.001) -> DataFrame:
    """Groups whose amounts don't cancel out (QLT-07)."""
    return df.groupBy(*group).agg(F.sum(amount).alias("total")).where(F.abs("total") > tolerance)


def sequence_breaks(df: DataFrame, group: list[str], seq: str, order: list[str]) -> DataFrame:
    """Rows whose sequence doesn't follow its predecessor's by one, with the step (QLT-08, QLT-09, ANO-11)."""
    out = lagged(df, group, order[0], order, [seq]).withColumn("previous", F.col(f"_before.{seq}")).drop("_before")
    return out.withColumn("step", F.col(seq) - F.col("previous")).where("step != 1")


def temporal_jumps(df: DataFrame, group: list[str], ts: str, order: list[str]) -> DataFrame:
    """Rows after a gap above an hour, a step back above a minute, or a gap above five times the median of the last 50 positive ones
    once there are ten (VAL-24, VAL-25)."""
    w = Window.partitionBy(*group, "_block").orderBy("_n")
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    out = blocks(df, group, order[0], order, 51).withColumn("gap_s", (us - F.lag(us).over(w)) / 1000000)
    before = w.rowsBetween(-50, -1)
    out = out.withColumn("_positive", F.when(F.col("gap_s") > 0, F.col("gap_s")))
    out = out.withColumn("median_gap", F.percentile("_positive", 0.5).over(before)).withColumn("_seen", F.count("_positive").over(before))
    kind = F.when(F.col("gap_s") > 3600, "jump").when(F.col("gap_s") < -60, "backwards").when((F.col("_seen") >= 10) & (F.col("gap_s") > 5 * F.col("median_gap")), "irregular")
    return out.withColumn("kind", kind).where("_own AND kind IS NOT NULL").drop("_positive", "_seen", "_n", "_block", "_own")
