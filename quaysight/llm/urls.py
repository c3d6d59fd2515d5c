"""URL filters: rules of host and path, and for the rest a ratio of character language models.

URLs that a rule accepts or rejects train two variable-order Markov models: counts of each character after its last 0 to ORDER
characters, smoothed by interpolation from the shortest context to the longest. The difference of the two log-likelihoods per
character, set against the middle between the means of the accepted and of the rejected URLs, judges the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The characters that the models tell apart; all digits count as 0, other characters as one.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_?=&:#%+~,@!*"
ORDER = 3
_BASE = len(ALPHABET) + 2  # other characters, and the start
_CODES = np.array([0 if chr(c).lower() not in ALPHABET + "123456789" else ALPHABET.index("0" if chr(c).isdigit() else chr(c).lower()) + 1 for c in range(128)], np.int64)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty where it is null or has no ://."""
    at = F.instr(url, "://")
    after = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def ruled(pages: DataFrame) -> DataFrame:
    """pages with host, path, rule (the longest that fits, as host and path) and the rule's verdict; url is the column read."""
    host, path = parts(F.col("url"))
    out = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.endswith("host", F.lit(f".{h}"))) & F.startswith("path", F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return out.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def coded(url: str) -> np.ndarray:
    """The characters of a URL as numbers, after ORDER start marks."""
    points = np.frombuffer(url.encode("utf-32-le"), np.uint32)
    codes = np.where(points < 128, _CODES[np.minimum(points, 127)], 0)
    return np.concatenate([np.full(ORDER, _BASE - 1), codes])


def contexts(codes: np.ndarray, order: int) -> np.ndarray:
    """A number for each character with its last `order` characters."""
    n = len(codes) - ORDER
    out = codes[ORDER:].copy()
    for k in range(1, order + 1):
        out += codes[ORDER - k : ORDER - k + n] * _BASE**k
    return out


def counts(urls: DataFrame) -> DataFrame:
    """(label, cell, n): how often each character follows its last ORDER characters, over all URLs. A label has at most
    _BASE ** (ORDER + 1) cells, however many URLs there are; shorter contexts are sums of these."""

    def run(batches):
        for batch in batches:
            for label in (0, 1):
                of = [coded(u) for u, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if y == label]
                if of:
                    cell, n = np.unique(np.concatenate([contexts(c, ORDER) for c in of]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), label, np.int32)), pa.array(cell), pa.array(n.astype(np.int64))], names=["label", "cell", "n"])

    return urls.select("url", "label").mapInArrow(run, "label int, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))


class Markov:
    """Log-probabilities by interpolation: p_k = (count + strength * p_(k-1)) / (total of the context + strength)."""

    def __init__(self, cells: np.ndarray, n: np.ndarray, strength: float = 4.0):
        p = np.full((1, _BASE), 1 / _BASE)
        for k in range(ORDER + 1):
            # A cell has the character as its lowest digit, then the context from the nearest character on: the rows of order k
            # whose nearest k - 1 characters agree follow each other at a distance of the rows of order k - 1.
            table = np.bincount(cells % _BASE ** (k + 1), n, _BASE ** (k + 1)).reshape(-1, _BASE)
            prior = np.tile(p, (len(table) // len(p), 1))
            p = (table + strength * prior) / (table.sum(axis=1, keepdims=True) + strength)
        self.log = np.log(p).astype(np.float32).ravel()

    def score(self, cell: np.ndarray) -> float:
        return float(self.log[cell].sum())


def ratio(url: str, accept: Markov, reject: Markov) -> float:
    """Log-likelihood difference per character; an empty URL has 0."""
    cell = contexts(coded(url), ORDER)
    return (accept.score(cell) - reject.score(cell)) / max(len(cell), 1)


def judge(pages: DataFrame) -> DataFrame:
    """pages with host, path, rule, score (of every URL) and verdict: the rule's, else allow if the score reaches the threshold.

    The counts cover all ruled URLs, repeated ones as often as they stand. Null URLs count as empty. Input columns named host, path,
    rule, score or verdict are replaced; an empty table gives an empty one; a long URL is scored whole. If rules accept or reject nothing, the models are equal and all
    scores 0, which is allowed. The threshold is the middle between the mean scores of both kinds of ruled URLs.
    """
    marked = ruled(pages)
    seen = marked.where("rule_verdict is not null").select(F.coalesce("url", F.lit("")).alias("url"), F.when(F.col("rule_verdict") == "allow", 1).otherwise(0).alias("label"))
    table = counts(seen).toArrow()  # at most 2 * _BASE ** (ORDER + 1) rows
    label, cell, n = (table[c].to_numpy() for c in ("label", "cell", "n"))
    reject, accept = (Markov(cell[label == y], n[label == y]) for y in (0, 1))
    kept = [c for c in marked.columns if c != "score"]
    sc = pages.sparkSession.sparkContext
    models = sc.broadcast((accept.log, reject.log))  # dense tables of a fixed size

    def score(batches):
        a, r = (Markov.__new__(Markov) for _ in range(2))
        a.log, r.log = models.value
        for batch in batches:
            s = [ratio(u or "", a, r) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s, pa.float64())], names=[*(f"k{i}" for i in range(len(kept))), "score"])

    schema = ", ".join([*(f"k{i} {marked.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)), "score double"])

    def scored(rows: DataFrame) -> DataFrame:
        found = rows.select(F.col("url").alias("source"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(kept)]).mapInArrow(score, schema)
        return found.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kept)], "score")

    # Only the ruled URLs are scored for the threshold: a filter behind the scoring would score all.
    middle = scored(marked.where("rule_verdict is not null")).groupBy("rule_verdict").agg(F.avg("score").alias("m")).collect()  # two rows
    threshold = sum(r["m"] for r in middle) / len(middle) if len(middle) == 2 else 0.0
    return scored(marked).withColumn("verdict", F.coalesce("rule_verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))).drop("rule_verdict")
