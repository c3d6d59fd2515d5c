"""Secret scans: fixed patterns, and strings in a sensitive place that zstandard can't compress.

A candidate of the second kind is a run of token characters, or of such joined by dots, that starts close behind a sensitive word,
on its line or a later one, or right behind a reported one; a joined run that isn't reported is tried by its parts. So is the body
of a private key between its marks. It is compressed with a dictionary primed with common identifiers and with the text around it:
what its surroundings or an identifier explain costs few bytes, a random string nearly as many as it has. Candidates whose marginal
bytes per character reach a threshold are reported.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

# The patterns and lengths of the base kinds, in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"h{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
# Words that make a place sensitive, and identifiers that are no secrets.
_SENSITIVE = re.compile(rb"(?i)password|passwd|passphrase|secret|token|api[\s_-]?key|access[\s_-]?key|private[\s_-]?key|credential|bearer|authorization|signature")
_SENSITIVE_WORDS = (b"pass", b"secret", b"token", b"key", b"credential", b"bearer", b"authorization", b"signature")
IDENTIFIERS = (
    "access_token refresh_token authorization bearer client_id client_secret configuration connection_string credentials database default_password "
    "description development document environment example_password expires_in generateToken getElementById getPassword identifier implementation "
    "information localhost password_hash placeholder production public_key redirect_uri requirements response_type secret_manager secretsmanager "
    "session_token signature_version test_password tokenizer tokenization undefined username validate_token xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"
)
# Words that identifiers are made of; the dictionary has them as they stand in camel case and in snake case.
WORDS = (
    "access account action address admin application array async attribute authentication authorization backend base binary body buffer build button cache "
    "call callback certificate change channel check client cloud code collection column command commit component config configuration connection container "
    "content context control controller cookie counter create credential current custom data database date debug decode default delete description device "
    "directory dispatcher document domain driver dynamic element email encode endpoint engine entity entry environment error event example execute export "
    "external factory feature fetch field file filter find format frame function generate get global group handle handler hash header helper history host "
    "image implementation import index info input insert instance integer interface internal item iterator job key label language layer library limit line "
    "link list listener load local login manager map message method mode model module name network node number object option order output page parameter "
    "parser path payload pool process property provider proxy query queue random read record reference register request resource response result route rule "
    "schema script section select send server service session set signature source start state status storage store stream string system table target task "
    "template test text thread time type update upload user validate value variable version view window worker write"
).split()
_PRIMER = (" ".join(w.title() for w in WORDS).replace(" ", "") + "_".join(WORDS)).encode()
_HEX_TO_H = bytes(104 if 48 <= c <= 57 or 97 <= c <= 102 else 32 for c in range(256))
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
_PART = re.compile(rb"[A-Za-z0-9+/_=-]+")
_PEM = re.compile(rb"-----BEGIN [A-Z0-9\x20]*PRIVATE KEY-----\s*+(?:[A-Za-z-]++:[^\n]*+\n\s*+)*+((?:[A-Za-z0-9+/=]++\s*+)++)-----END")
LEAST_CANDIDATE = 16
#: Candidates are measured by pieces of so many characters, as longer ones are coded by the frequencies of their characters too.
PIECE = 64
#: Stands before a piece, so that what any compressed block costs isn't the piece's: bytes that nothing explains, and ones of the dictionary.
_BEFORE = hashlib.sha256(b"").digest() + _PRIMER[300:600]
_DICTIONARY = _PRIMER + b" " + IDENTIFIERS.encode() + b" "


def _size(data: bytes, dictionary: bytes) -> int:
    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False).compress(data))


_NOTHING = _size(_BEFORE, _DICTIONARY)


def marginal_bytes(candidate: bytes, around: bytes) -> int:
    """Bytes that the candidate adds, compressed after the identifiers and its surroundings: 0.95 or more a character for random ones, 0.94
    or less for names of words, and the less the longer these are."""
    pieces = [candidate[k : k + PIECE] for k in range(0, len(candidate), PIECE)]
    return sum(_size(_BEFORE + p, _DICTIONARY + around) - _NOTHING for p in pieces)


def find(text: bytes, reach: int = 48, around: int = 512, least_novelty: float = 0.9) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) of each span, sorted; byte offsets."""
    low = text.lower()
    spans = []
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    if b"AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text.translate(_HEX_TO_H))]
    if any(w in low for w in _SENSITIVE_WORDS):
        known, done = [(s, e) for s, _, e in spans], 0

        def novel(start: int, end: int) -> bool:
            before = bisect_right(starts, start)
            if end - start < LEAST_CANDIDATE or before and reached[before - 1] >= end:
                return False
            near = text[max(0, start - around) : start] + b" " + text[end : end + around]
            if marginal_bytes(text[start:end], near) < least_novelty * (end - start):
                return False
            spans.append((start, 3, end))
            return True

        if b"PRIVATE KEY-----" in text:
            starts, reached = [], []
            bodies = [(m.start(1), m.start(1) + len(m[1].rstrip())) for m in _PEM.finditer(text)]
            known += [body for body in bodies if novel(*body)]
        known.sort()
        starts, reached = [s for s, _ in known], list(accumulate((e for _, e in known), max))
        for word in _SENSITIVE.finditer(text):
            at, limit = max(done, word.end()), word.end() + reach
            while m := _RUN.search(text, at, limit):
                m = _RUN.match(text, m.start())
                at = done = m.end()
                found = novel(*m.span())
                if not found and b"." in m[0]:
                    found = any([novel(*p.span()) for p in _PART.finditer(text, *m.span())])
                if found:  # the lines of one value follow each other
                    limit = max(limit, done + len(text[done : done + reach]) - len(text[done : done + reach].lstrip()) + 1)
    return sorted(spans)


def scan(docs: DataFrame, text_col: str = "text", redacted: bool = False) -> DataFrame:
    """docs with spans array<struct<kind string, start long, end long>> in code points, sorted by start and kind.

    With `redacted`, also a column of the text whose spans are replaced by <secret>. Null and empty texts have no spans. Columns of
    docs are kept, save those of the added names. Spans of different kinds may overlap; a text is scanned whole in one task, in time
    that grows with its length. Rows are independent, so that repeated ones give equal results and an empty table an empty one.
    """
    added = ["spans"] + ["redacted"] * redacted
    kept = [c for c in docs.columns if c not in added]

    def run(batches):
        for batch in slices(batches, 0):
            kinds, starts, ends, sizes, clean = [], [], [], [0], []
            for text in texts(batch, 0):
                found = find(text)
                # The code points before each byte, if they aren't as many.
                points = None if not found or text.isascii() else np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).tolist()
                point = (lambda at: at) if points is None else (lambda at, points=points: points[at] - 1)
                for s, k, e in found:
                    kinds.append(KINDS[k])
                    starts.append(point(s))
                    ends.append(starts[-1] + e - s)  # all characters of a span are ASCII
                sizes.append(len(kinds))
                if redacted:
                    out, at = [], 0
                    for s, _, e in found:
                        if s >= at:
                            out += [text[at:s], b"<secret>"]
                        at = max(at, e)
                    clean.append((b"".join(out) + text[at:]).decode())
            spans = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["kind", "start", "end"]))
            out = [*batch.columns[1:], spans] + ([pa.array(clean, pa.string())] if redacted else [])
            yield pa.RecordBatch.from_arrays(out, names=[f"k{i}" for i in range(len(kept))] + added)

    fields = [f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(kept)]
    schema = ", ".join([*fields, "spans array<struct<kind string, start long, end long>>"] + ["redacted string"] * redacted)
    out = docs.select(F.col(text_col).alias("source"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(kept)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kept)], *added)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
