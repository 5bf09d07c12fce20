"""Secret scans with multipart credential linking.

Three base detectors find what is a secret by its form alone. Weak candidates (short secrets, mixed tokens
without a keyword, account identifiers, endpoints) say nothing alone; they are reported only where parts
that complement each other co-occur: an identifier or endpoint with a secret, in one scope, neither a piece of the
other. A scope is a paragraph (blank lines part them) and a reach of some characters around a part. The interval
join of a document's parts sorts the starts and the ends of one kind and counts by bisection how many meet each
interval of the other, so a text with very many parts costs n log n and no pair is ever built.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches, stateless

#: Characters around a part within which a complement counts.
REACH = 200
#: Bits a character that a token without keyword needs.
MIN_ENTROPY = 3.5

#: The base detectors.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 16
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")  # whole runs, which [0-9a-f]+ finds
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "id", "endpoint", "weak")

IDENTIFIER = re.compile(r"(?:client_?id|access_?key_?id|account_?id|user_?name|user|login)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]{3,})", re.IGNORECASE | re.ASCII)
IDENTIFIER_HINTS = ("client", "access", "account", "user", "login")
ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]+|(?:host|server|endpoint)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+(?::[0-9]+)?", re.IGNORECASE | re.ASCII)
ENDPOINT_HINTS = ("://", "host", "server", "endpoint")
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")

Span = tuple[int, int, int]  # start, place of its kind in KINDS, end


def base_spans(text: str, low: str | None = None) -> tuple[list[Span], list[Span]]:
    """Base spans, and the assignments whose value is too short to be one."""
    low = text.lower() if low is None else low
    spans, short = [], []
    if any(h in low for h in ASSIGN_HINTS) or not low.isascii():
        for m in ASSIGN.finditer(text):
            (spans if len(m[2]) >= ASSIGN_CHARS else short).append((m.start(), 0, m.end()))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans, short


def entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def _touching(starts: np.ndarray, ends: np.ndarray, of: list[Span]) -> np.ndarray:
    """How many of the spans `of` each of the intervals (starts, ends) meets."""
    if not of:
        return np.zeros(len(starts), np.int64)
    other = np.array(of)
    # those that begin before its end, but for those that end before it begins
    return np.searchsorted(np.sort(other[:, 0]), ends, "left") - np.searchsorted(np.sort(other[:, 2]), starts, "right")


def linked(text: str, base: list[Span], short: list[Span], low: str, reach: int = REACH) -> list[Span]:
    """Weak candidates that have their complement in scope."""
    identifiers = [(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)] if any(h in low for h in IDENTIFIER_HINTS) else []
    endpoints = [(m.start(), 4, m.end()) for m in ENDPOINT.finditer(text)] if any(h in low for h in ENDPOINT_HINTS) else []
    if not (identifiers or endpoints or any(k == 1 for _, k, _ in base)):
        return []
    strong = [s for s in base if s[1] != 1]
    weak = [(s, 5, e) for s, _, e in short]
    for m in BARE.finditer(text):
        t = m[0]
        if re.search("[0-9]", t) and re.search("[A-Z]", t) and re.search("[a-z]", t) and entropy(t) >= MIN_ENTROPY:
            weak.append((m.start(), 5, m.end()))

    def apart(own: list[Span], others: list[Span]) -> list[Span]:
        """What is part of another span isn't a candidate of its own."""
        at = np.array(own).reshape(-1, 3)
        return [o for o, t in zip(own, _touching(at[:, 0], at[:, 2], others), strict=True) if not t]

    weak = apart(weak, [*base, *endpoints])
    identifiers = apart(identifiers, [s for s in [*base, *weak] if s[1] in (0, 5)])
    if not strong and not weak:
        return []
    cuts = np.array([m.end() for m in BLANK_LINE.finditer(text)])

    def meets(own: list[Span], others: list[Span]) -> np.ndarray:
        """Spans of own whose scope meets any of others, besides those that they overlap themselves."""
        if not own:
            return np.zeros(0, bool)
        at = np.array(own)
        first = np.r_[0, cuts][np.searchsorted(cuts, at[:, 0], "right")] if len(cuts) else np.zeros(len(at), int)
        after = np.r_[cuts, len(text)][np.searchsorted(cuts, at[:, 0], "right")] if len(cuts) else np.full(len(at), len(text))
        return _touching(np.maximum(at[:, 0] - reach, first), np.minimum(at[:, 2] + reach, after), others) > _touching(at[:, 0], at[:, 2], others)

    names = [s for s in base if s[1] == 1] + identifiers
    secrets = strong + weak
    out = [w for w, ok in zip(weak, meets(weak, names + endpoints), strict=True) if ok]
    out += [i for i, ok in zip(identifiers, meets(identifiers, secrets), strict=True) if ok]
    out += [e for e, ok in zip(endpoints, meets(endpoints, secrets), strict=True) if ok]
    return out


def scan(text: str, reach: int = REACH) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that linking adds) of a text, each in order of start and kind."""
    low = text.lower()
    base, short = base_spans(text, low)
    return sorted(base), sorted(linked(text, base, short, low, reach))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row of df: id, counts of each base kind and of linked spans, digest of the base spans, all spans.

    Spans are kind:start:end in code points, end exclusive, by start, then kind. Null text counts as empty and
    has no spans; repeated rows give repeated results; an empty table gives an empty result. Only the two
    columns are read.
    """
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stateless()
        for batch in batches:
            counts, digests, every = [], [], []
            for t in batch.column(1):
                base, more = scan(t.as_py(), reach)
                n = Counter(k for _, k, _ in base)
                counts.append((n[0], n[1], n[2], len(more)))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined(sorted(base + more)))
            columns = np.array(counts, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(columns[:, i]) for i in range(4)), pa.array(digests, pa.string()), pa.array(every, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_linked", "base_sha256", "spans"],
            )

    out = own.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_linked long, base_sha256 string, spans string")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
