"""Secret scans with multipart credential linking.

Base patterns (assign, access, hex) are reported wherever they match. Weak
candidates mean little alone: an account name, a bare 40-character key, an
endpoint. They are reported only when complementary parts stand within the same
scope, found by an interval join: two parts join if at most ``reach`` code
points lie between their spans, and no blank line (white space alone, whatever
ends its lines) does.

* ident (account ids and names, mail addresses, other key ids): needs a secret part.
* key (bare mixed 40-character strings, pass/key/auth assignments): needs an access id or ident.
* endpoint (URLs with a scheme, cloud hosts): needs both an access id or ident and a secret part.

A group is reported whole: an ident or key that an endpoint is reported for is
reported too, even if the group's other part is out of its own reach.

Secret parts are assign, hex and key. A weak span that overlaps a base span is
part of it and not reported again. The join is a merge over the sorted spans of
one text: nothing is shuffled, no pairs are emitted, memory is that of a text.

Every pattern reads a run of letters a bounded number of times, so texts of any
length take time in proportion. Parts at equal distance all count (a part needs
one partner), so ties change nothing.

Null and empty texts have no spans, an empty table gives no rows; texts are scanned
whole; repeated rows are scanned alike. Result columns of secret_scan() replace
input columns of the same names; clean() returns all input columns and replaces
text and n_chars alone.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shielded

REACH = 200
BLANK_LINE = re.compile(r"\n[^\S\n]*\n|\r[^\S\r\n]*\r")
#: Kinds in the order of the report, and their patterns.
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 or more; a shorter run holds no longer one
HEX = re.compile(r"[0-9a-f]{24,}")
#: A mail address begins where its run of letters and marks does, so every run is read once.
IDENT = re.compile(r"""(?i:\b(?:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key_?id)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9._@-]{3,})|\b(?:ASIA|AIDA|AROA)[A-Z0-9]{16}\b|(?<![A-Za-z0-9._-])[._-]*+(?P<mail>[A-Za-z0-9][A-Za-z0-9._-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)""", re.ASCII)
KEY = re.compile(r"""(?i:\b(?:pass|pwd|key|auth|credential)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]{8,})|(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])""", re.ASCII)
ADDRESS = re.compile(r"""\b(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", re.ASCII)
CLOUD = re.compile(r"\.(?:amazonaws\.com|windows\.net|googleapis\.com)\b", re.ASCII)
HOST_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789.-")


def ident_spans(text: str) -> list[tuple[int, int]]:
    return [m.span("mail") if m["mail"] else m.span() for m in IDENT.finditer(text)]


def key_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in KEY.finditer(text)]


def endpoint_spans(text: str) -> list[tuple[int, int]]:
    """Addresses with a scheme; cloud hosts outside them, each from the beginning of its run to its last known ending."""
    found = [m.span() for m in ADDRESS.finditer(text)]
    within, last = Spans(found), 0
    hosts: list[tuple[int, int]] = []
    for m in CLOUD.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in HOST_LETTERS:
            start -= 1
        if hosts and start == hosts[-1][1] == last and start < m.start():
            start = hosts.pop()[0]
        if start < m.start():
            hosts.append((start, m.end()))
            last = m.end()
    return sorted(found + [h for h in hosts if not within.overlap(*h)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, per kind leftmost and not overlapping."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Spans:
    """Sorted spans, which may overlap, with the greatest end up to each."""

    def __init__(self, spans):
        self.spans = sorted(spans)
        self.ends = list(accumulate((e for _, e in self.spans), max))

    def __bool__(self) -> bool:
        return bool(self.spans)

    def overlap(self, start: int, end: int) -> bool:
        i = bisect_left(self.spans, (end, -1))
        return i > 0 and self.ends[i - 1] > start

    def near(self, text: str, start: int, end: int, reach: int) -> bool:
        """Does one of the spans lie within reach of [start, end), in its scope?"""
        i = bisect_left(self.spans, (start, end))
        gaps = [(self.ends[i - 1], start)] if i else []  # of those before, the one that ends last is nearest
        gaps += [(end, s) for s, _ in self.spans[i : i + 1]]
        return any(b - a <= reach and not (a < b and BLANK_LINE.search(text, a, b)) for a, b in gaps)


def scan(text: str | None, reach: int = REACH) -> list[tuple[int, int, int]]:
    """All spans (start, kind number, end) of a text in order."""
    if not text:
        return []
    base = base_spans(text)
    taken = Spans((s, e) for s, _, e in base)

    def free(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return [x for x in spans if not taken.overlap(*x)]

    access = [(s, e) for s, k, e in base if k == 1]
    secret = [(s, e) for s, k, e in base if k != 1]
    key = free(key_spans(text))
    if not secret and not key:  # nothing weak can be complete without a secret part
        return base
    ident = free(ident_spans(text))
    names, secrets = Spans(access + ident), Spans(secret + key)
    whole = [x for x in free(endpoint_spans(text)) if names.near(text, *x, reach) and secrets.near(text, *x, reach)] if names else []
    between = Spans(whole)  # what lies near one of these is part of a complete group, however far its other parts are
    found = base + [(s, 5, e) for s, e in whole]
    found += [(s, 3, e) for s, e in ident if secrets.near(text, s, e, reach) or between.near(text, s, e, reach)]
    found += [(s, 4, e) for s, e in key if names.near(text, s, e, reach) or between.near(text, s, e, reach)]
    return sorted(found)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans) -> str:
    """The text with every stretch covered by spans replaced by the kind of the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def secret_scan(docs: DataFrame, reach: int = REACH, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex (long), base_sha256, spans and redacted (the cleaned text).

    ``keep_text`` False leaves both texts out.
    """
    new = [("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"), ("spans", "string")] + [("redacted", "string")] * keep_text
    kept = [f for f in docs.schema if f.name not in {n for n, _ in new} and (keep_text or f.name != text)]
    schema = T.StructType([*kept, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in new]])
    types = {"long": pa.int64(), "string": pa.string()}

    def run(batches):
        for batch in batches:
            rows, cleaned = [], []
            for t in batch.column(text).to_pylist():
                spans = scan(t, reach)
                base = [x for x in spans if x[1] < 3]
                n = [sum(k == j for _, k, _ in base) for j in range(3)]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
                if keep_text:
                    cleaned.append(redact(t, spans) if spans else t)
            cols = [*zip(*rows)] or [()] * 5
            cols += [cleaned] * keep_text
            arrays = [batch.column(f.name) for f in kept] + [pa.array(list(c), types[t]) for c, (_, t) in zip(cols, new)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])

    return docs.select(*dict.fromkeys([*[f.name for f in kept], text])).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return secret_scan(docs, keep_text=False).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets taken out of the text, and n_chars after it; other columns stay as they are, whatever their names."""

    def run(named: DataFrame) -> DataFrame:
        out = secret_scan(named).withColumn("text", F.col("redacted"))
        if "n_chars" in docs.columns:
            out = out.withColumn("n_chars", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))
        return out

    return shielded(docs, ["text", "n_chars"], run)
