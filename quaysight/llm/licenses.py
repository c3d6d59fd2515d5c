"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser evaluates expressions.

Phrases are matched on the words of a text, tags on the text itself, by one automaton. A tag `SPDX-License-Identifier:` is followed,
up to the end of its line, by an expression of identifiers, and, or, with and parentheses, which becomes the set of licences it
names and whether all of them are open. Identifiers are taken in their usual spellings: a family and a version make one name.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts
from .winnow import words_of

# Phrases as words, and their labels. The first three are the base phrases.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3.0",
    "mozilla public license": "mpl-2.0",
    "eclipse public license": "epl-2.0",
    "boost software license": "bsl-1.0",
    "isc license": "isc",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0-1.0",
    "creative commons attribution": "cc-by",
    "all rights reserved": "proprietary",
}
# Families of identifiers with the parts of their versions (as 2.0) or a form of their own, those of them that are open, and
# names that stand for others.
VERSIONED = {
    "afl": 2, "agpl": 2, "apache": 2, "apsl": 2, "artistic": 2, "bsl": 2, "cc-by": 2, "cc-by-nc": 2, "cc-by-nc-nd": 2, "cc-by-nc-sa": 2, "cc-by-nd": 2, "cc-by-sa": 2, "cc0": 2, "cddl": 2, "cecill": 2, "cpl": 2, "ecl": 2, "efl": 1, "epl": 2, "eupl": 2,
    "frameworx": 2, "gfdl": 2, "gpl": 2, "ijg": 0, "ipl": 2, "lgpl": 2, "lppl": 2, "lpl": 2, "mpl": 2, "ms-lpl": 0, "npl": 2, "odbl": 2, "ofl": 2, "osl": 2, "php": 2, "postgresql": 0, "psf": 2, "python": 2, "qpl": 2, "rpl": 2, "sgi-b": 2, "sissl": 2, "spl": 2, "sspl": 2, "upl": 2, "vsl": 2, "w3c": 0, "zpl": 2,
}
OPEN_FAMILIES = {"apache", "bsl", "cc-by", "cc0", "cddl", "ecl", "epl", "mpl", "ofl", "php", "psf", "python", "upl", "zpl", "artistic"}
OPEN = {"mit", "apache-2", "isc", "bsd", "bsd-2-clause", "bsd-3-clause", "0bsd", "mit-0", "unlicense", "zlib", "cc-by", "postgresql", "ncsa", "x11", "curl", "icu", "ntp", "blueoak-1.0.0", "wtfpl"}
ALIASES = {"expat": "mit", "asl": "apache", "gplv": "gpl", "lgplv": "lgpl", "agplv": "agpl", "mplv": "mpl", "new-bsd": "bsd-3-clause", "simplified-bsd": "bsd-2-clause", "freebsd": "bsd-2-clause", "boost": "bsl-1.0", "public-domain": "unlicense", "cc-zero": "cc0-1.0"}
_VERSION = re.compile(r"^([a-z0-9-]*?[a-z0-9])[-_]?v?(\d+(?:\.\d+)*)(\+|-or-later|-only)?$")
_BSD = re.compile(r"^bsd[-_]?([0-4])(?:[-_]?clause)?$")
RANK = {"or": 1, "and": 2, "with": 3}
TAG = "spdx-license-identifier:"
_LINE_END = re.compile(r"[\r\n]")
#: What tells an identifier from a word of prose: a digit, a hyphen, or the name of a licence family.
_SHAPED = re.compile(r"[0-9-]|^(?:mit|isc|zlib|unlicense|wtfpl|beerware|bsd|gpl|lgpl|agpl|apache|python|ruby|perl|curl|ncsa|vim|x11|openssl|artistic|icu|ntp|tcl|json)$")
_EXCEPTION = re.compile(r"\bwith\s+([a-z0-9.+-]+)")
_TOKEN = re.compile(r"\(|\)|[a-z0-9.+-]+")


@lru_cache(100_000)
def canonical(name: str) -> str:
    """The usual name of an identifier in small letters: gplv2+ and gpl-2.0-or-later are one. Unknown ones stay as they are."""
    name = ALIASES.get(name, name)
    if m := _BSD.match(name):
        return "0bsd" if m[1] == "0" else f"bsd-{m[1]}-clause"
    m = _VERSION.match(name)
    family = m and ALIASES.get(m[1], m[1])
    if family == "cc" or not m or family not in VERSIONED:
        return name
    parts = m[2].split(".")
    version = ".".join(parts + ["0"] * (VERSIONED[family] - len(parts)))
    return f"{family}-{version}" + {"+": "-or-later", None: ""}.get(m[3], m[3])


def is_open(name: str) -> bool:
    """Whether a canonical name is that of an open licence without conditions on derived works as a whole."""
    m = _VERSION.match(name)
    return name in OPEN or bool(m and m[1].rstrip("-") in OPEN_FAMILIES)


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in (BASE | NOTICES).items():
        found.add_word(f" {phrase} ", (phrase, label, phrase in BASE))
    found.add_word(TAG, (TAG, None, False))
    found.make_automaton()
    return found


def evaluate(expression: str) -> tuple[set[str], bool] | None:
    """(licences named, whether the terms can be met by open licences only) of an expression, by operator precedence with,
    and, or; reading stops where the expression ends. None if it isn't one."""
    values: list[tuple[set[str], bool]] = []
    stack: list[str] = []

    def apply() -> bool:
        op = stack.pop()
        if op == "(" or len(values) < 2:
            return False
        (b, b_open), (a, a_open) = values.pop(), values.pop()
        values.append((a, a_open) if op == "with" else (a | b, a_open or b_open if op == "or" else a_open and b_open))
        return True

    operand, trailing = True, False
    for token in (m[0] for m in _TOKEN.finditer(expression.lower())):
        if operand and token == "(":
            stack.append(token)
        elif operand and token not in RANK and token != ")":
            named = token if stack and stack[-1] == "with" else canonical(token)
            values.append(({named}, is_open(named)))
            operand = False
        elif not operand and token in RANK:
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[token]:
                if not apply():
                    return None
            stack.append(token)
            operand = True
        elif not operand and token == ")" and "(" in stack:
            while stack[-1] != "(":
                if not apply():
                    return None
            stack.pop()
        else:
            trailing = True
            break
    if trailing and len(values) == 1 and not stack and not any(_SHAPED.search(name) for name in values[0][0]):
        return None  # a sentence that begins with a word
    if operand and stack and stack[-1] in RANK:
        stack.pop()
    while stack:
        if stack[-1] == "(":
            stack.pop()
        elif not apply():
            return None
    return values[0] if len(values) == 1 else None


def find(text: bytes) -> tuple[int, list[tuple[int, int, str, bool]], list[tuple[str, set[str], bool]]]:
    """(number of words, phrase matches as (first word, last word, label, base), expressions)."""
    words = words_of(text)
    line = f" {b' '.join(words).decode()} "
    matches, at, seen = [], 0, 0
    for end, (phrase, label, base) in automaton().iter(line):
        start = end - len(phrase) - 1  # of the space before the phrase
        if start < at:
            first = line.count(" ", 0, start)
        else:
            first = seen + line.count(" ", at, start)
            at, seen = start, first
        matches.append((first, first + phrase.count(" "), label, base))
    low = text.lower()
    expressions = []
    if b"spdx" in low:
        raw = low.decode("utf-8", "ignore")
        tags = [end + 1 for end, (phrase, _, _) in automaton().iter(raw) if phrase == TAG]
        for start, following in zip(tags, [t - len(TAG) for t in tags[1:]] + [len(raw)]):
            line_end = _LINE_END.search(raw, start, following)  # an expression ends with its line or at the next tag
            written = raw[start : line_end.start() if line_end else following]
            value = evaluate(written)
            if value:
                expressions.append((written.strip(), *value))
    return len(words), matches, expressions


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, matches array<struct<first long, last long, label string, base boolean>> in order of their ends, and
    expressions array<struct<text string, licenses array<string>, exceptions array<string>, open boolean>>.

    Null and empty texts have no words. Columns of docs are kept, save those of the added names. A long text is scanned whole in one
    task; rows are independent, so that repeated ones give equal results and an empty table an empty one.
    """
    added = ["n_words", "matches", "expressions"]
    kept = [c for c in docs.columns if c not in added]
    match = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
    expression = pa.list_(pa.struct([("text", pa.string()), ("licenses", pa.list_(pa.string())), ("exceptions", pa.list_(pa.string())), ("open", pa.bool_())]))

    def run(batches):
        for batch in slices(batches, 0):
            rows = [find(t) for t in texts(batch, 0)]
            found = [[dict(zip(("first", "last", "label", "base"), m)) for m in r[1]] for r in rows]
            terms = [[{"text": t, "licenses": sorted(names), "exceptions": _EXCEPTION.findall(t), "open": is_open} for t, names, is_open in r[2]] for r in rows]
            out = [*batch.columns[1:], pa.array([r[0] for r in rows], pa.int64()), pa.array(found, match), pa.array(terms, expression)]
            yield pa.RecordBatch.from_arrays(out, names=[f"k{i}" for i in range(len(kept))] + added)

    fields = [f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)]
    schema = ", ".join([*fields, "n_words long, matches array<struct<first long, last long, label string, base boolean>>, expressions array<struct<text string, licenses array<string>, exceptions array<string>, open boolean>>"])
    out = docs.select(F.col(text_col).alias("source"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(kept)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kept)], *added)
