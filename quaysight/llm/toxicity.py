"""Toxicity by a learnt lexicon, misspellings and context.

The lexicon (whole words and stems that words begin with) is learnt from labelled texts: terms that occur in toxic ones far more
often than chance allows. A word is looked up in the lexicon's trie, and a Levenshtein automaton of the word runs along the trie to
find terms at one edit. The words around each hit tell quotation (quotation marks, words of reporting) from abuse (address), and a
logistic model over the hits gives the score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts, written
from .quality import sampled
from .simhash import shingle_hashes, spread
from .winnow import words_of

STEMS = range(4, 9)
#: Kinds of a word: none, a lexicon word, a word that begins with a stem, a misspelt lexicon word.
NONE, EXACT, STEM, FUZZY = range(4)
# What marks a quotation or report, and what addresses a reader.
_MARKS = ((b'"', b'"'), (b"\xe2\x80\x9c", b"\xe2\x80\x9d"), (b"\xe2\x80\x9e", b"\xe2\x80\x9c"), (b"\xc2\xab", b"\xc2\xbb"))
_REPORTED = re.compile(rb"\b(?:said|says|wrote|called|quote[sd]?|term|word|slur|reported|dijo|dit|sagte)\b")
_DIRECTED = re.compile(rb"\b(?:you|your|youre|ur|du|dich|dein|vous|toi|tu|te|usted|eres)\b")
REACH = 60
REMEMBERED = 250_000


def in_quotation(before: bytes, after: bytes) -> bool:
    """Whether what stands between is quoted: a mark opened before it that is closed behind it only, or a word of reporting before it."""
    for start, end in _MARKS:
        opened = before.count(start) % 2 == 1 if start == end else before.rfind(start) > before.rfind(end)
        if opened and end in after:
            return True
    return bool(_REPORTED.search(before))


class Automaton:
    """Accepts what is within `most` edits of a word; a state is a tuple of (letters of the word used, edits)."""

    def __init__(self, word: str, most: int = 1):
        self.word, self.most = word, most

    def start(self) -> tuple:
        return tuple((i, i) for i in range(self.most + 1) if i <= len(self.word))

    def step(self, state: tuple, c: str) -> tuple:
        best: dict[int, int] = {}
        for i, e in state:
            if i < len(self.word):
                cost = e + (self.word[i] != c)
                if cost <= self.most:
                    best[i + 1] = min(best.get(i + 1, 99), cost)
            if e < self.most:
                best[i] = min(best.get(i, 99), e + 1)
        for i in sorted(best):  # letters of the word may be left out
            for j in range(i + 1, len(self.word) + 1):
                if best[i] + j - i > self.most:
                    break
                best[j] = min(best.get(j, 99), best[i] + j - i)
        return tuple(sorted(best.items()))

    def accepts(self, state: tuple) -> bool:
        return any(e + len(self.word) - i <= self.most for i, e in state)


@dataclass
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]
    trie: dict = field(default_factory=dict)
    heads: frozenset[str] = frozenset()
    tails: frozenset[str] = frozenset()
    known: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        # One edit leaves the first or the second half of a term whole: other words needn't be run along the trie.
        long = [w for w in self.words if len(w) >= 4]
        self.heads = frozenset(w[: len(w) // 2] for w in long)
        self.tails = frozenset(w[len(w) // 2 :] for w in long)
        self.head_sizes, self.tail_sizes = sorted({len(x) for x in self.heads}), sorted({len(x) for x in self.tails})
        for w in long:
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def misspelt(self, word: str) -> str | None:
        """A lexicon word at one edit, found along the trie by the word's automaton."""
        auto = Automaton(word)
        todo = [(self.trie, auto.start())]
        while todo:
            node, state = todo.pop()
            for c, child in node.items():
                if c == "":
                    if auto.accepts(state):
                        return child
                elif after := auto.step(state, c):
                    todo.append((child, after))
        return None

    def kind(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if word in self.words:
                found = EXACT
            elif any(word[:n] in self.stems for n in STEMS):
                found = STEM
            elif len(word) >= 4 and (any(word[:n] in self.heads for n in self.head_sizes) or any(word[-n:] in self.tails for n in self.tail_sizes)) and self.misspelt(word):
                found = FUZZY
            else:
                found = NONE
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    def features(self, text: bytes) -> list[float]:
        """Hits by kind, those in a quoting context and those in a directed one, as logarithms; and the share of words that hit."""
        words = words_of(text)
        hits = {}
        for w in set(words):
            if kind := self.kind(w.decode()):
                hits[w] = kind
        counts, quoted, directed, n = [0, 0, 0, 0], 0, 0, 0
        if hits:
            low = text.lower()
            for m in re.finditer(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(re.escape(w) for w in sorted(hits)) + rb")(?![0-9a-z\x80-\xff])", low):
                counts[hits[m[0]]] += 1
                before, after = low[max(0, m.start() - REACH) : m.start()], low[m.end() : m.end() + REACH]
                quoted += in_quotation(before, after)
                directed += bool(_DIRECTED.search(before) or _DIRECTED.search(after))
                n += 1
        x = [*counts[1:], quoted, directed]
        return [1.0, *np.log1p(x), float(bool(n)), n / max(len(words), 1)]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, self.lexicon.features(text)), -30, 30))))


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): in how many texts of either label each word and each stem occurs."""

    def run(batches):
        for batch in slices(batches):
            seen: dict[tuple[str, bool], list[int]] = {}
            for label, text in zip(batch.column(0).to_pylist(), texts(batch)):
                words = {w.decode() for w in words_of(text)}
                for key in {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEMS if len(w) >= n}:
                    seen.setdefault(key, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.bool_()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["term", "stem", "toxic", "clean"])

    return rows.select("label", "text").mapInArrow(run, "term string, stem boolean, toxic long, clean long").groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Terms whose share of toxic texts is at least 0.9 and can't be chance, given how many terms are tried; a word or stem that
    begins with a chosen stem is left to it. rows: (label, text), a bounded number."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        return Lexicon(frozenset(), frozenset())
    base = n[1] / (n[0] + n[1])
    counts = written(term_counts(rows).where("toxic > 0"), "terms")
    least = float(np.log(max(counts.count(), 1))) + 5
    total = F.col("toxic") + F.col("clean")
    gain = F.col("toxic") * F.log(F.col("toxic") / (total * base)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (total * (1 - base)))).otherwise(0.0)
    found = counts.where((F.col("toxic") >= 0.9 * total) & (gain >= least)).select("term", "stem").collect()  # few of a bounded sample's terms
    stems: set[str] = set()
    for t in sorted((r["term"] for r in found if r["stem"]), key=len):
        if not any(t[:k] in stems for k in STEMS):
            stems.add(t)
    # A stem that only one word has is that word.
    words = {r["term"] for r in found if not r["stem"]}
    alone = {s for s in stems if sum(w.startswith(s) for w in words) == 1 and any(w == s for w in words)}
    return Lexicon(frozenset(words), frozenset(stems - alone))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = 20_000) -> Model:
    """Learns from a bounded sample of about `most` labelled rows at most. Copies and near copies (one of four equal MinHash values
    of their five-word shingles) count once, else the words of a copied text would pass for toxic terms. The regression's few features per
    sampled row come to the driver; without rows of both labels every score is the base rate. Rows of one id stay or go together."""

    def keyed(batches):
        for batch in slices(batches, 2):
            keys = [[int(spread(h, k).min()) - 2**63 for k in range(4)] if len(h := shingle_hashes(t, 5)) else [0] * 4 for t in texts(batch, 2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=["id", "label", "text", "keys"])

    rows = sampled(docs.select(id_col, text_col), labels, id_col, label_col, most).select(F.col(id_col).cast("long").alias("id"), "label", F.col(text_col).alias("text"))
    rows = written(rows.mapInArrow(keyed, "id long, label int, text string, keys array<long>"), "labelled")
    first = rows.select("id", "keys")  # the texts needn't be dealt by their keys
    for k in range(4):
        first = first.groupBy(F.col("keys")[k].alias("key")).agg(F.min(F.struct("id", "keys")).alias("r")).select("r.*")
    rows = written(rows.join(first.select("id").distinct(), "id", "left_semi"), "labelled")
    lexicon = learn_lexicon(rows)

    def run(batches):
        for batch in slices(batches):
            x = [lexicon.features(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    found = rows.select("label", "text").mapInArrow(run, "label int, x array<double>").toArrow()
    x, y = np.array(found["x"].to_pylist(), dtype=float).reshape(-1, 8), found["label"].to_numpy().astype(float)
    order = np.lexsort([*x.T, y])
    return Model(lexicon, fit(x[order], y[order]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with the column score; null counts as empty. Columns of docs are kept, save one named score. A long text is scored whole in
    one task; rows are independent, so that repeated ones score alike and an empty table gives an empty one."""
    kept = [c for c in docs.columns if c != "score"]

    def run(batches):
        for batch in slices(batches, 0):
            s = [model.score(t) for t in texts(batch, 0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s, pa.float64())], names=[*(f"k{i}" for i in range(len(kept))), "score"])

    schema = ", ".join([*(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)), "score double"])
    out = docs.select(F.col(text_col).alias("source"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(kept)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kept)], "score")
