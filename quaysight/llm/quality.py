"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Shallow trees are boosted on one feature after the other in turn and summed into a lookup
table per feature; then the pairs of features that explain most of what is left get tables of two dimensions the same way. A
score is the logistic function of the sum of the bins' values.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

FEATURES = (
    "log_words", "word_length", "distinct_words", "repeats", "distinct_pairs", "upper", "digits", "symbols", "stops", "bars", "marks", "high_bytes", "entropy", "line_words", "distinct_lines", "longest_word",
)


def features(text: bytes) -> list[float]:
    """Figures of a text; an empty one has zeros."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, size = max(len(words), 1), max(len(text), 1)
    letters = max(int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()), 1)
    symbols = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    stops = int(counts[[44, 46, 63, 59, 58]].sum())
    p = counts[counts > 0] / size
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / n,
        counts[65:91].sum() / letters,
        counts[48:58].sum() / size,
        (symbols - stops) / size,
        stops / n,
        counts[124] / n,
        counts[33] / n,
        counts[128:].sum() / size,
        float(-(p * np.log2(p)).sum()) if len(text) else 0.0,
        float(np.log1p(len(words) / max(len(lines), 1))),
        len(set(lines)) / max(len(lines), 1),
        float(np.log1p(max(map(len, words), default=0))),
    ]


@dataclass
class Additive:
    """cuts: the bin edges of each feature; tables: a value per bin; pairs: (feature, feature, coarse edges of both, values)."""

    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, f], side="right")]
        for f, g, a, b, table in self.pairs:
            total += table[np.searchsorted(a, x[:, f], side="right"), np.searchsorted(b, x[:, g], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def stump(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float = 1.0, least: float = 2.0) -> np.ndarray:
    """A tree over ordered bins with up to `leaves` leaves: the Newton step of each bin's leaf."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None)
        for lo, hi in parts:
            gs, hs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            left, right = hs[:-1], hs[-1] - hs[:-1]
            gain = np.where((left >= least) & (right >= least), gs[:-1] ** 2 / (left + ridge) + (gs[-1] - gs[:-1]) ** 2 / (right + ridge) - gs[-1] ** 2 / (hs[-1] + ridge), 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (lo, lo + int(gain.argmax()) + 1, hi))
        if best[1] is None:
            break
        lo, mid, hi = best[1]
        parts.remove((lo, hi))
        parts += [(lo, mid), (mid, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 32, coarse: int = 8, n_pairs: int = 6) -> Additive:
    """Cyclic boosting over the features, then over the pairs of most gain. Without rows or with one class, the base rate."""
    base = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(base / (1 - base))), [], [], [])
    if len(y) == 0 or y.min() == y.max():
        model.cuts, model.tables = [np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES)
        return model
    model.cuts = [edges(x[:, f], bins) for f in range(x.shape[1])]
    at = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.start)
    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            p = 1 / (1 + np.exp(-total))
            step = rate * stump(np.bincount(at[f], y - p, len(table)), np.bincount(at[f], p * (1 - p), len(table)), 3)
            table += step
            total += step[at[f]]
    rough = [edges(x[:, f], coarse) for f in range(x.shape[1])]
    cell = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(rough)]
    p = 1 / (1 + np.exp(-total))

    def grid(f, g, values):
        shape = (len(rough[f]) + 1, len(rough[g]) + 1)
        return np.bincount(cell[f] * shape[1] + cell[g], values, shape[0] * shape[1]).reshape(shape)

    gains = {(f, g): (grid(f, g, y - p) ** 2 / (grid(f, g, p * (1 - p)) + 1)).sum() for f, g in combinations(range(x.shape[1]), 2)}
    chosen = sorted(gains, key=gains.get, reverse=True)[:n_pairs]
    tables = {k: np.zeros((len(rough[k[0]]) + 1, len(rough[k[1]]) + 1)) for k in chosen}
    for _ in range(rounds // 3):
        for f, g in chosen:
            p = 1 / (1 + np.exp(-total))
            gr, he = grid(f, g, y - p), grid(f, g, p * (1 - p))
            cut = int(np.argmax([(gr[:i].sum() ** 2) / (he[:i].sum() + 1) + (gr[i:].sum() ** 2) / (he[i:].sum() + 1) for i in range(1, len(gr))] or [0])) + 1
            step = np.zeros_like(gr)
            for part in (slice(0, cut), slice(cut, None)):
                step[part] = rate * stump(gr[part].sum(0), he[part].sum(0), 2)[None, :]
            tables[f, g] += step
            total += step[cell[f], cell[g]]
    model.pairs = [(f, g, rough[f], rough[g], t) for (f, g), t in tables.items()]
    return model


def held_out(id_col: str, mod: int, rest: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """About `most` labelled rows at most: (id, label, text columns of docs), chosen by a hash of the id."""
    known = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    share = min(1.0, most / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.join(F.broadcast(chosen.limit(2 * most)), id_col)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = 20_000) -> Additive:
    """Fits the model on a bounded sample of the labelled documents: about `most` rows, of which the features come to the driver.
    Repeated labels or documents count as often as they stand; null labels and ids don't. Without both labels every score is the base
    rate."""

    def run(batches):
        for batch in slices(batches):
            x = [features(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    rows = sampled(docs.select(id_col, text_col), labels, id_col, label_col, most).select("label", text_col).mapInArrow(run, "label int, x array<double>").toArrow()
    x = np.array(rows["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, rows["label"].to_numpy()])  # the fit doesn't depend on the order in which rows arrive
    return fit(x[order], rows["label"].to_numpy()[order].astype(float))


def score(docs: DataFrame, model: Additive, text_col: str = "text") -> DataFrame:
    """docs with the column score; null counts as empty. Columns of docs are kept, save one named score. A long text is scored whole in
    one task; rows are independent, so that repeated ones score alike and an empty table gives an empty one."""
    kept = [c for c in docs.columns if c != "score"]

    def run(batches):
        for batch in slices(batches, 0):
            s = model.score(np.array([features(t) for t in texts(batch, 0)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s)], names=[*(f"k{i}" for i in range(len(kept))), "score"])

    schema = ", ".join([*(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)), "score double"])
    out = docs.select(F.col(text_col).alias("source"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(kept)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kept)], "score")
