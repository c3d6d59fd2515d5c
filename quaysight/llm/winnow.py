"""Benchmark decontamination by winnowing.

Texts become words, words 64-bit hashes, K consecutive words a k-gram hash. Of each W consecutive k-grams the smallest hash is
kept, ties included. Two texts that share W + K - 1 consecutive words share the k-grams of that span and so a kept one: with
K = 5 and W = 6 no shared span of ten words is missed. Kept k-grams of documents that pass a bit filter of the benchmark's (of a size
that follows from its k-grams, 16 MB at most) are joined with the benchmark's, each with the words around it, and a hit is extended
word by word; it counts if the span reaches ten words. Items of fewer words are looked up whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_filter, bits_for, in_filter, slices, texts, written

SPAN, K = 10, 5
W = SPAN - K + 1
#: A-Z to lower case; the other ASCII characters but digits and a-z to spaces.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[bytes]:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text whose A-Z are lower-cased."""
    return text.translate(_TO_WORDS).split()


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    h = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ words[i : i + len(h)]) * np.uint64(MULTIPLIER)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def sliding(h: np.ndarray, n: int, smallest: bool) -> np.ndarray:
    """The smallest or largest of each n consecutive values."""
    pick = np.minimum if smallest else np.maximum
    out, size = h, 1
    while size < n:
        step = min(size, n - size)
        out = pick(out[: len(out) - step], out[step:])
        size += step
    return out


def winnowed(h: np.ndarray, w: int = W) -> np.ndarray:
    """Which hashes are the smallest of some w consecutive ones; of fewer, all are kept."""
    if len(h) < w:
        return np.ones(len(h), bool)
    low = sliding(h, w, True)
    edge = np.full(w - 1, np.iinfo(np.int64).min)
    return sliding(np.concatenate([edge, low, edge]), w, False) == h


def item_grams(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, n, hash, at, words): kept k-grams (n = 0) of the items with their place among the SPAN - K words on either side,
    and whole short items (n = their words)."""

    def run(batches):
        for batch in slices(batches):
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch)):
                words = words_of(text)
                hashes = word_hashes(words)
                if len(words) >= SPAN:
                    grams = gram_hashes(hashes, K)
                    for p in np.flatnonzero(winnowed(grams)).tolist():
                        start = max(0, p - SPAN + K)
                        rows.append((item, 0, int(grams[p]), p - start, b" ".join(words[start : p + SPAN]).decode()))
                elif words:
                    rows.append((item, len(words), int(gram_hashes(hashes, len(words))[0]), 0, b" ".join(words).decode()))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string()))], names=["item", "n", "hash", "at", "words"])

    return items.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "item long, n int, hash long, at int, words string")


def doc_grams(docs: DataFrame, id_col: str, text_col: str, bits: np.ndarray, short: list[int]) -> DataFrame:
    """(row, id, n_words, n, hash, at, words, places): what may meet an item. row tells the documents apart, of equal ids too. A row
    without hash only counts the words; places holds the word indices of the k-grams (or of the whole short match) that have the
    same words around them."""

    def run(batches):
        for batch in slices(batches):
            rows = []
            ids, numbers = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            all_words = [words_of(t) for t in texts(batch)]
            sizes = np.array([len(w) for w in all_words], np.int64)
            first = np.concatenate([[0], np.cumsum(sizes)])
            hashes = word_hashes([w for ws in all_words for w in ws])
            found: dict[tuple, list[int]] = {}
            for n in (0, *short):
                grams = gram_hashes(hashes, n or K)
                keep = in_filter(bits, grams) & (winnowed(grams) if n == 0 else True)
                for p in np.flatnonzero(keep).tolist():
                    d = int(np.searchsorted(first, p, side="right")) - 1
                    if p + (n or K) > first[d + 1]:
                        continue
                    q = p - int(first[d])
                    start = max(0, q - SPAN + K) if n == 0 else q
                    context = b" ".join(all_words[d][start : q + (n or SPAN)])
                    found.setdefault((d, n, int(grams[p]), q - start, context), []).append(q)
            for d, (i, size) in enumerate(zip(ids, sizes.tolist())):
                rows.append((numbers[d], i, size, -1, None, None, None, None))
            rows += [(numbers[d], ids[d], 0, n, h, at, context.decode(), places) for (d, n, h, at, context), places in found.items()]
            kinds = (pa.int64(), batch.column(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["row", "id", "n_words", "n", "hash", "at", "words", "places"])

    numbered = docs.select(F.col(id_col).cast("long"), text_col, F.monotonically_increasing_id())  # of one written table
    return numbered.mapInArrow(run, "row long, id long, n_words long, n int, hash long, at int, words string, places array<int>")


def extended() -> F.Column:
    """struct(lo, hi): how far the shared span of the two contexts reaches around the k-gram, relative to its first word; null if
    the k-grams differ or the span stays below SPAN words."""
    a, b = F.split("d.words", " "), F.split("i.words", " ")
    da, ia = F.col("d.at"), F.col("i.at")
    same = lambda k: F.get(a, da + k) == F.get(b, ia + k)
    left, right = F.lit(0), F.lit(0)
    for k in range(SPAN - K, 0, -1):
        left = F.when((da >= k) & (ia >= k) & same(F.lit(-k)), left + 1).otherwise(F.lit(0))
    for k in range(SPAN - 1, K - 1, -1):
        right = F.when(same(F.lit(k)), right + 1).otherwise(F.lit(0))
    whole = F.slice(a, da + 1, K) == F.slice(b, ia + 1, K)
    return F.when(whole & (left + right + K >= SPAN), F.struct((-left).alias("lo"), (right + K).alias("hi")))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: id_col, n_words, n_hit, items (sorted ids as strings of the items with occurring windows), contaminated.

    Null and empty texts have no words. Repeated words, items and documents, of equal or null ids too, count each as they stand. An
    empty benchmark leaves every document clean; an empty table gives an empty one. Work is shuffled for what passes the filter only,
    and what several items share is expanded once. A very long text is one task's work. Only the named columns are read.
    """
    grams = written(item_grams(items, item_col, item_text), "items")
    bits = bit_filter(grams, "hash", bits_for(grams.count()))
    short = [r["n"] for r in grams.select("n").distinct().where("n > 0").collect()]  # at most SPAN - 1 numbers
    found = written(doc_grams(docs, id_col, text_col, bits, sorted(short)), "grams")
    hits = found.where("n >= 0").alias("d").join(grams.alias("i"), (F.col("d.hash") == F.col("i.hash")) & (F.col("d.n") == F.col("i.n")))
    reach = F.when(F.col("d.n") > 0, F.when(F.col("d.words") == F.col("i.words"), F.struct(F.lit(0).alias("lo"), F.col("d.n").alias("hi")))).otherwise(extended())
    hits = written(hits.select("d.row", F.col("i.item").alias("item"), "d.places", reach.alias("reach")).where("reach is not null"), "hits")
    named = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    spans = hits.select("row", "places", "reach").distinct()
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p + F.col("reach.lo"), p + F.col("reach.hi") - 1)))
    counted = spans.groupBy("row").agg(F.size(F.array_distinct(F.flatten(F.collect_list(covered)))).cast("long").alias("n_hit"))
    out = found.where("n < 0").select("row", "id", "n_words").join(named.join(counted, "row"), "row", "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))
