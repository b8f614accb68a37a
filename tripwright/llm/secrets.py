"""Secret scan with multipart credential linking.

Some parts of a credential say little alone: a long random-looking value, an account id, a service address. The scan
finds strong spans by pattern and gathers weak parts (identifiers, values, endpoints). Each part covers a scope, its
own place widened by ``scope`` code points; an interval join of the scopes of identifiers with those of values and
endpoints links parts, and a weak value or endpoint is reported only when an identifier and a value stand together.

Kinds, in order: ``assign``, ``access``, ``hex`` (strong, always reported), ``linked`` (a weak value beside an access
identifier), ``endpoint`` (an address beside such an identifier and a value). Positions are code points, ends
exclusive. A document is one row, so that the join runs inside it: both sides are sorted by place and swept once.

Defined cases: a null or empty text has no spans; repeated rows give repeated results; an empty table gives an empty
table; other columns stay as they are in ``redact`` and are ignored in ``scan``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import bounded_batches, texts_of

KINDS = ("assign", "access", "hex", "linked", "endpoint")
STRONG = KINDS[:3]
SCOPE = 256
MARK = "[SECRET]"

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of 24 or more; shorter runs are no matches, so that nothing else has to be dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
#: Weak parts: a value of the length and alphabet of a secret key, and an address of a service.
#: Padding stands after a value only, so that a value may follow ``key=``.
VALUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?")
#: One scan for the words that any assignment starts with decides whether the longer pattern is tried at all.
MIN_ASSIGN, MIN_ACCESS = 6, 20

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Strong spans, leftmost and without overlaps for each kind."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def near(parts: list[Span], others: list[Span], scope: int) -> list[Span]:
    """Parts whose scope meets the scope of any of the others: an interval join over sorted starts.

    The others of one kind don't overlap, so that starts and ends have the same order and the first that ends
    late enough decides.
    """
    ends = [end for _, _, end in others]
    out = []
    for part in parts:
        at = bisect_left(ends, part[1] - scope)
        if at < len(others) and others[at][1] <= part[2] + scope:
            out.append(part)
    return out


def linked_spans(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """Weak parts that complete each other within a scope."""
    identifiers = [s for s in base if s[0] == "access"]
    if not identifiers:
        return []
    values = [("linked", *m.span()) for m in VALUE.finditer(text)]
    taken = sorted((a, b) for kind, a, b in base if kind in ("assign", "hex"))
    known = [("linked", a, b) for a, b in taken]
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    free = []
    for value in values:  # what is reported already needs no second span
        at = bisect_left(starts, value[2])
        if not at or reach[at - 1] <= value[1]:
            free.append(value)
    found = near(free, identifiers, scope)
    secrets = sorted(found + known, key=lambda s: s[1])
    # endpoints need an identifier and a value, be it weak or strong
    secrets = [s for s in secrets if near([s], identifiers, scope)]
    secrets = [s for k, s in enumerate(secrets) if k == 0 or s[1] >= secrets[k - 1][2]]
    endpoints = [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)] if secrets else []
    return found + near(near(endpoints, identifiers, scope), secrets, scope)


def listed(spans: list[Span]) -> str:
    """``kind:start:end`` by start, then kind."""
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in order)


def all_spans(text: str, scope: int = SCOPE) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    return base, base + linked_spans(text, base, scope)


def redacted(text: str, scope: int = SCOPE) -> str:
    """The text with every span replaced by a mark; spans that overlap share one."""
    out, end, spans = [], 0, sorted((a, b) for _, a, b in all_spans(text, scope)[1])
    if not spans:
        return text
    for a, b in spans:
        if a >= end:
            out += [text[end:a], MARK]
        end = max(end, b)
    return "".join([*out, text[end:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each row, one pass without a shuffle."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(text, scope) for text in texts_of(batch.column(1))]
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in STRONG]
            digests = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_pydict(
                {id_col: batch.column(0)}
                | {f"n_{k}": pa.array(n, pa.int64()) for k, n in zip(STRONG, counts, strict=True)}
                | {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array([listed(spans) for _, spans in found], pa.string())}
            )

    schema = f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(id_col, text_col).mapInArrow(find, schema)


def redact(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """The same rows and columns, with each span in the text replaced by a mark; null stays null."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redacted(t, scope))

    return docs.withColumn(text_col, cleaned(F.col(f"`{text_col}`")))
