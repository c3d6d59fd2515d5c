"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes lower-case letters and single spaces; its n-grams of 1 to ORDERS characters are hashed to buckets. Training counts the
n-grams of all labelled documents in their tasks and sums (language, bucket, n) over tasks, so that only sums are shuffled. The matrix
of log probabilities, bounded by CELLS, is broadcast; a batch of texts is scored by adding the matrix rows of its buckets in numpy.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

ORDERS = 4
#: The most cells of the matrix (64 MB), buckets and languages; more languages have fewer buckets each.
CELLS, BUCKETS, LANGUAGES = 1 << 24, 1 << 16, 1 << 12
#: Added to each count.
SMOOTHING = 0.1
#: Texts have their log probabilities divided by their n-grams to this power before scores are made of them: n-grams overlap.
TEMPER = 0.5
_FACTOR = np.uint32(0x9E3779B1)


@functools.cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def characters(column: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, text of each, letters of each text): letters in lower case, one space for what lies between, before and behind
    them. A character 0 parts the texts."""
    raw = np.frombuffer("\0".join((t or "").replace("\0", " ").lower() for t in column).encode("utf-32-le", "replace"), np.uint32)
    of = np.cumsum(raw == 0)
    edge, letter = raw == 0, letters()[raw]
    found = np.bincount(of[letter], minlength=len(column))
    plain = np.where(letter | edge, raw, np.uint32(32))
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != 32) | (plain[:-1] != 32)
    plain, of = plain[keep], of[keep]
    # A space on either side of each text, unless there is one.
    gaps = np.flatnonzero(plain == 0)
    before = np.concatenate([[0], gaps + 1])
    behind = np.concatenate([gaps, [len(plain)]])
    at = np.ravel(np.stack([before, behind], axis=1))
    out = np.insert(plain, at, np.uint32(32))
    of = np.insert(of, at, np.repeat(np.arange(len(column)), 2))
    twice = np.zeros(len(out), bool)
    twice[1:] = (out[1:] == 32) & (out[:-1] == 32)
    return out[~twice], of[~twice], found


def buckets(points: np.ndarray, of: np.ndarray, orders: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of the n-grams of each order that lie in one text and aren't a space alone."""
    h = np.zeros(len(points), np.uint32)
    inside = points != 0
    for n in range(1, orders + 1):
        if len(points) < n:
            return
        h = (h[: len(points) - n + 1] ^ points[n - 1 :]) * _FACTOR  # the n-gram that starts here
        h ^= h >> np.uint32(15)
        inside = inside[: len(h)] & (points[n - 1 :] != 0)
        use = inside & ((points != 32) if n == 1 else True)
        mixed = h[use] * np.uint32(0x85EBCA6B) + np.uint32(n)
        yield ((mixed ^ (mixed >> np.uint32(13))) & np.uint32(size - 1)).astype(np.int64), of[: len(h)][use]


@dataclass
class Bayes:
    """languages in order; prior: the log share of each one's documents; matrix: log probabilities by bucket and language."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray
    orders: int = ORDERS

    def scores(self, column: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log scores by text and language, letters, n-grams) of texts."""
        points, of, found = characters(column)
        total, grams = np.tile(self.prior, (len(column), 1)), np.zeros(len(column), np.int64)
        some = max(1, (1 << 22) // max(len(self.languages), 1))
        for bucket, text in buckets(points, of, self.orders, len(self.matrix)):
            grams += np.bincount(text, minlength=len(column))
            for x in range(0, len(bucket), some):
                first = np.flatnonzero(np.diff(text[x : x + some], prepend=-1))
                total[text[x + first]] += np.add.reduceat(self.matrix[bucket[x : x + some]], first, axis=0, dtype=np.float64)
        return total, found, grams


def counts(docs: DataFrame, orders: int, size: int) -> DataFrame:
    """(lang, bucket, n) over docs (lang, text); bucket -1 counts the documents."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}

        def rows():
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at - 1), pa.array(n[at])], names=["lang", "bucket", "n"])
            sums.clear()

        for batch in slices(batches, 1, 500_000):
            names = batch.column(0).to_pylist()
            points, of, _ = characters(batch.column(1).to_pylist())
            kinds = {name: k for k, name in enumerate(dict.fromkeys(names))}
            kind = np.array([kinds[name] for name in names])
            for name, k in kinds.items():
                sums.setdefault(name, np.zeros(size + 1, np.int64))[0] += int((kind == k).sum())
            for bucket, text in buckets(points, of, orders, size):
                which = kind[text]
                for name, k in kinds.items():
                    sums[name][1:] += np.bincount(bucket[which == k], minlength=size)
            if len(sums) * size > CELLS // 4:
                yield from rows()
        yield from rows()

    return docs.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", orders: int = ORDERS) -> Bayes:
    """Counts all documents with a language. Of more than LANGUAGES languages those of most documents are learned, ties by name; the
    number of buckets follows from their number. Repeated documents count as often as they stand; texts without letters, null ones
    too, count for the share of their language only. Without any document no language is learned."""
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    shares = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).toArrow()  # LANGUAGES rows at most
    names = sorted(shares["lang"].to_pylist())
    size = BUCKETS
    while size * len(names) > CELLS:
        size //= 2
    kept = known.where(F.col("lang").isin(names)) if len(names) == LANGUAGES else known
    found = counts(kept, orders, size).toArrow()  # CELLS rows at most, of each language its buckets
    place = {name: k for k, name in enumerate(names)}
    row = np.array([place[x] for x in found["lang"].to_pylist()], np.int64)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    table = np.zeros((size, len(names)), np.float64)
    grams = bucket >= 0
    table[bucket[grams], row[grams]] = n[grams]
    prior = np.zeros(len(names))
    prior[row[~grams]] = n[~grams]
    table += SMOOTHING
    return Bayes(names, np.log(prior / max(prior.sum(), 1)), np.log(table / table.sum(axis=0)).astype(np.float32), orders)


def predict(docs: DataFrame, model: Bayes, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score. Null texts and those without a letter are `und` with score 0, as all are if no language was learned.
    Ties go to the language that comes first. score: the share of the best language when log scores are divided by the root of the
    number of n-grams. Columns of docs are kept, save ones of these two names. Rows are independent: repeated ones are predicted
    alike, and an empty table gives an empty one. A very long text is scored whole, in one task."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS cells at most

    def run(batches):
        for batch in slices(batches, 0, 500_000):
            m = shared.value
            column = batch.column(0).to_pylist()
            if m.languages:
                total, found, grams = m.scores(column)
                best = total.argmax(axis=1)
                share = np.exp((total - total.max(axis=1, keepdims=True)) / np.maximum(grams, 1)[:, None] ** TEMPER)
                score = np.where(found > 0, 1 / share.sum(axis=1), 0.0)
                names = [m.languages[b] if f else "und" for b, f in zip(best.tolist(), found.tolist())]
            else:
                names, score = ["und"] * len(column), np.zeros(len(column))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(names, pa.string()), pa.array(score)], names=[*(f"k{i}" for i in range(len(kept))), "lang_pred", "score"])

    schema = ", ".join([*(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)), "lang_pred string", "score double"])
    out = docs.select(F.col(text_col).alias("source"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(kept)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kept)], "lang_pred", "score")
