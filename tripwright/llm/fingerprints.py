"""Document fingerprints from prefix polynomial hashes.

A text's code points go through a prefix array of a polynomial modulo 2**64. The array gives the hash
of any span by one subtraction, so that two spans are compared without reading them, and the longest common
extension of two places is found by binary search over span lengths.

The fingerprint is a sample of span hashes: every span of ``SPAN`` code points is hashed through the array, and the
``SKETCH`` least different hashes are kept (shorter texts: the whole text is the one span). Likeness is the share of
common hashes among the least ``SKETCH`` of both, which estimates the Jaccard likeness of the span sets; it is 1 for
equal fingerprints.

Defined cases: a null text is empty; an empty text has an empty fingerprint, which is like another empty one only.
The next row is that with the next id; rows with equal ids follow by text; the last is followed by the first, and a
single row by itself. Null ids stand first. Empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import NULL_ID, bounded_batches, input_bytes, sha256_hex

#: The modulus is 2**64, where products need no division; the base is odd, so that its powers have inverses.
BASE = 0x9E3779B97F4A7C15 | 1
MODULUS = 1 << 64
#: Polynomials of this modulus are safe for short spans; equal hashes of longer ones are confirmed by reading them.
SAFE_SPAN = 512
SPAN = 24
SKETCH = 64
#: Text bytes of one range of ids that a task holds at once.
RANGE_BYTES = 4 << 20


class PrefixHashes:
    """Prefix array of one text: ``spans_equal`` and ``common_extension`` for any places."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    @classmethod
    def tables(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse, grown by doubling."""
        if len(cls._powers) < n:
            size = 1 << max(14, int(n - 1).bit_length())
            cls._powers, cls._inverse = powers(BASE, size), powers(pow(BASE, -1, MODULUS), size)
        return cls._powers, cls._inverse

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.n = codes, len(codes)
        power, self.inverse = self.tables(self.n + 1)
        # code points are spread over all bits first
        values = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        values ^= values >> np.uint64(29)
        self.prefix = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * power[: self.n], out=self.prefix[1:])

    def span(self, start: int, length: int) -> int:
        """Hash of one span; equal spans have equal hashes wherever they stand."""
        return (int(self.prefix[start + length]) - int(self.prefix[start])) * int(self.inverse[start]) % MODULUS

    def windows(self, length: int) -> np.ndarray:
        """Hash of the span of one length at each place."""
        n = max(0, self.n - length + 1)
        return (self.prefix[length : length + n] - self.prefix[:n]) * self.inverse[:n]

    def spans_equal(self, a: int, b: int, length: int, other: PrefixHashes | None = None) -> bool:
        other = other or self
        if self.span(a, length) != other.span(b, length):
            return False
        return length <= SAFE_SPAN or np.array_equal(self.codes[a : a + length], other.codes[b : b + length])

    def common_extension(self, a: int, b: int, other: PrefixHashes | None = None) -> int:
        """Length of the longest common extension of place ``a`` here and ``b`` in the other text."""
        other = other or self
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            half = (low + high + 1) // 2
            low, high = (half, high) if self.spans_equal(a, b, half, other) else (low, half - 1)
        return low


def powers(base: int, size: int) -> np.ndarray:
    out, step = np.ones(1, np.uint64), base
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % MODULUS
    return out[:size]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def spans_of(hashes: PrefixHashes) -> np.ndarray:
    """Mixed hashes of all spans; a text shorter than a span is one span, an empty one has none."""
    if not hashes.n:
        return np.zeros(0, np.uint64)
    found = hashes.windows(SPAN) if hashes.n >= SPAN else np.array([hashes.span(0, hashes.n)], np.uint64)
    return mixed(found)


def mixed(spans: np.ndarray) -> np.ndarray:
    """An order of hashes that doesn't depend on the texts; 62 bits."""
    spans = (spans ^ (spans >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (spans ^ (spans >> np.uint64(32))) >> np.uint64(2)


def sketch(*spans: np.ndarray) -> np.ndarray:
    """The least different values of all arrays."""
    n = sum(map(len, spans))
    share = 4 * SKETCH
    while True:  # only values below a bound are sorted; repeats may ask for a higher one
        top = np.uint64(min((1 << 62) - 1, (1 << 62) * share // max(n, 1)))
        found = np.unique(np.concatenate([x[x <= top] for x in spans]))
        if len(found) >= SKETCH or share >= n:
            return found[:SKETCH].astype(np.int64)
        share *= 8


def edited_sketch(text: str, own_spans: np.ndarray, after_spans: np.ndarray, changed: str) -> np.ndarray:
    """Sketch of an edited text from the spans of its two parts and those that cross the seam."""
    seam = len(text) - len(text) // 2
    rest = len(changed) - seam
    if seam < SPAN or rest < SPAN:
        return sketch(spans_of(PrefixHashes(code_points(changed))))
    crossing = spans_of(PrefixHashes(code_points(changed[seam - SPAN + 1 : seam + SPAN - 1])))
    return sketch(own_spans[: seam - SPAN + 1], crossing, after_spans[: rest - SPAN + 1])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SKETCH]
    return float((np.isin(both, a, True) & np.isin(both, b, True)).sum() / len(both))


def as_text(values: np.ndarray) -> str:
    return values.astype(">i8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">i8").astype(np.int64)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(rows: pd.DataFrame, following: list[str]) -> pd.DataFrame:
    """Fingerprints of rows and of their edited texts; ``following`` has the next text of each row."""
    out: dict[str, list] = {k: [] for k in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_start")}
    known: tuple | None = None
    for text, after in zip(rows["text"], following, strict=True):
        if known is None or known[0] != text:
            hashes = PrefixHashes(code_points(text))
            known = (text, hashes, spans_of(hashes))
        _, hashes, spans = known
        next_hashes = PrefixHashes(code_points(after))
        known = (after, next_hashes, spans_of(next_hashes))
        changed = edited(text, after)
        own, changed_sketch = sketch(spans), edited_sketch(text, spans, known[2], changed)
        out["n_chars"].append(len(text))
        out["edited_sha256"].append(sha256_hex(changed.encode()))
        out["fingerprint"].append(as_text(own))
        out["edited_fingerprint"].append(as_text(changed_sketch))
        out["near_edited"].append(likeness(own, changed_sketch))
        out["near_next"].append(likeness(own, sketch(known[2])))
        out["common_start"].append(hashes.common_extension(0, 0, next_hashes))
    return pd.DataFrame(out)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_start).

    Ids are cut into ranges by approximate percentiles, so that one shuffle brings neighbours together. A range also
    gets the first row of the range after it: one row for each range, found by its id.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("long"), F.lit(NULL_ID)))
    ranges = max(1, -(-input_bytes(docs, text_col) // range_bytes))
    shares = [k / ranges for k in range(1, ranges)]
    ids = rows.select("key")
    bounds = sorted(set(ids.agg(F.percentile_approx("key", shares, 10 * ranges + 1000)).first()[0] or [])) if shares else []

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in keys], dtype="int32")

    # a range starts at its bound, which is an id of the table; the first has the least id
    least = ids.agg(F.min("key")).first()[0]
    if least is None:
        least = NULL_ID
    firsts = sorted({least, *bounds})
    before = {first: bisect_right(bounds, firsts[k - 1]) for k, first in enumerate(firsts)}
    own = rows.withColumn("part", range_of("key")).withColumn("guest", F.lit(False))
    starts = spark.createDataFrame([(f, before[f]) for f in firsts], "key long, part int")
    # of rows with one first id the least text is the guest
    guests = (
        rows.join(F.broadcast(starts), "key").groupBy("key", "part").agg(F.min("text").alias("text"))
        .select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "text", "key", "part", F.lit(True).alias("guest"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_start long"

    def within(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["guest", "key", "text"], kind="stable", ignore_index=True)
        mine = group[~group["guest"]]
        following = group["text"].tolist()[1:]
        out = compare(mine, following[: len(mine)])
        out.insert(0, id_col, mine["id"].reset_index(drop=True))
        return out

    def in_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Ranges one after another; each is bounded by the bytes it was cut for."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            for part, some in batch.groupby("part", sort=False):
                if held and held[0]["part"].iloc[0] != part:
                    yield within(pd.concat(held, ignore_index=True))
                    held = []
                held.append(some)
        if held:
            yield within(pd.concat(held, ignore_index=True))

    every = own.unionByName(guests.select(*own.columns))
    dealt = every.repartition(ranges, "part").sortWithinPartitions("part")
    return dealt.mapInPandas(in_range, schema)
