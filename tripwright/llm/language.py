"""Language identification with error-correcting output codes.

Each language has a codeword of bits; a binary classifier over hashed byte n-grams (of 2 and of 4) predicts each bit, and
the language whose codeword has the least loss, weighted by how sure each bit is, wins. The lead over the second
codeword gives the score; a small lead flags the row as ambiguous.

The classifiers are logistic models fitted by gradient steps on a bounded sample of labelled rows:
``SAMPLE_ROWS`` rows at most for each language, the ones with the least hash of id and text. That is the only
bound; every row is predicted from its whole text.

Defined cases: ``und`` with score 0 if the text is null or has no letter, or if no row is labelled; repeated rows
give repeated results; an empty table gives an empty table; a language with a single row is learned from it; other
columns are ignored (``identify``) or kept inside the row's struct (``tagged``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import bounded_batches, let_go, text_bytes, texts_of

#: Bound of the training sample: rows of each language.
SAMPLE_ROWS = 300
#: Languages that one model may tell apart; more distinct labels than this are an error, not a cut.
MAX_LANGUAGES = 500
BUCKETS = 1 << 16
ORDERS = (2, 4)
SEED = 20240
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Rows with a lead below this are flagged.
AMBIGUOUS = 0.1
STRETCH = 1 << 18

_MIX = np.uint32(0x9E3779B1)


def gram_hashes(data: np.ndarray, order: int) -> np.ndarray:
    """A bucket for each n-gram of ASCII-lowered bytes."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    key = data[:n].copy()
    for k in range(1, order):
        key <<= np.uint32(8)
        key |= data[k : n + k]
    return (key * _MIX) >> np.uint32(16)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint32)


def code_matrix(classes: int) -> np.ndarray:
    """A codeword of +1 and -1 for each class: all splits of few classes, else random ones that lie far apart."""
    if classes <= 5:
        bits = np.array([[1 if (split >> c) & 1 else -1 for split in range(1, 1 << (classes - 1))] for c in range(classes)])
        return bits if classes > 1 else np.ones((classes, 1), np.int64)
    width = 8 * int(np.ceil(np.log2(classes)))
    rng, best, apart = np.random.default_rng(SEED), None, -1
    for _ in range(64):
        tried = rng.choice([-1, 1], (classes, width))
        least = min(int((tried[a] != tried[b]).sum()) for a in range(classes) for b in range(a))
        if least > apart and (np.abs(tried.sum(0)) < classes).all():
            best, apart = tried, least
    return best


@dataclass(frozen=True)
class CodeModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # a row of bit weights for each bucket
    bias: np.ndarray

    def bits(self, column: pa.Array) -> np.ndarray:
        """A real number for each row and bit; positive for +1. Long columns are read in stretches."""
        data, offsets = text_bytes(column)
        total = np.zeros((len(column), len(self.bias)))
        grams = np.zeros(len(column))
        for at in range(0, len(data), STRETCH):
            stop = min(len(data), at + STRETCH)
            some = lowered(data[at : min(len(data), stop + max(ORDERS) - 1)])
            first, last = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, stop, "left")
            inner = np.clip(offsets[first : last + 1], at, stop) - at
            for order in ORDERS:
                hashes = gram_hashes(some, order)[: stop - at]
                ends = np.minimum(np.maximum(np.minimum(inner[1:], offsets[first + 1 : last + 1] - at - order + 1), inner[:-1]), len(hashes))
                begin = np.minimum(inner[:-1], len(hashes))
                if (full := np.flatnonzero(ends > begin)).size:
                    edges = np.stack([begin[full], ends[full]], 1).ravel()
                    picked = np.concatenate([self.weights[hashes], np.zeros((1, total.shape[1]), np.float32)])
                    total[first + full] += np.add.reduceat(picked, edges, 0)[::2]
                grams[first:last] += ends - begin
        return total / np.maximum(grams, 1)[:, None] + self.bias

    def decode(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each row."""
        texts = texts_of(column)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        bits = self.bits(column)
        sure = 1 - np.exp(-np.abs(bits))  # how much a bit counts
        loss = np.logaddexp(0, -bits[:, None, :] * self.code[None]) * sure[:, None, :]
        mean = loss.sum(2) / np.maximum(sure.sum(1), 1e-9)[:, None]
        best = mean.argmin(1)
        likely = np.exp(-4 * (mean - mean.min(1, keepdims=True)))
        score = 1 / likely.sum(1)
        named = np.array([LETTER.search(t) is not None for t in texts], bool)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, named, strict=True)], np.where(named, score, 0.0)


def fit(column: pa.Array, languages: list[str], steps: int = 300) -> CodeModel:
    """Logistic models for the bits over mean n-gram counts."""
    names = sorted(set(languages))
    code = code_matrix(len(names)).astype(np.float64)
    if not names:
        return CodeModel([], np.zeros((0, 1)), np.zeros((BUCKETS, 1), np.float32), np.zeros(1))
    data, offsets = text_bytes(column)
    low = lowered(data)
    used, rows = np.zeros(BUCKETS, bool), []
    for a, b in zip(offsets, offsets[1:], strict=False):
        counts = np.zeros(BUCKETS, np.float32)
        for order in ORDERS:
            np.add.at(counts, gram_hashes(low[a:b], order), 1)
        counts /= max(counts.sum(), 1)
        at = np.flatnonzero(counts)
        used[at] = True
        rows.append((at, counts[at]))
    places = np.cumsum(used) - 1
    x = np.zeros((len(rows), int(used.sum())), np.float32)
    for k, (at, values) in enumerate(rows):
        x[k, places[at]] = values
    # rare n-grams count as much as common ones
    scale = np.minimum(1 / np.sqrt(np.einsum("ij,ij->j", x, x) / len(x) + 1e-9), 1e3).astype(np.float32)
    x *= scale
    target = code[[names.index(v) for v in languages]].astype(np.float32)
    share = np.array([1 / languages.count(v) for v in languages], np.float32)[:, None] / len(names)
    # the weights are sums of rows, so that steps over the rows' products give the same as steps over n-grams
    products = x @ x.T
    of_row, bias = np.zeros_like(target), np.zeros(code.shape[1], np.float32)
    rate = np.float32(2.0 / max(float(np.trace(products)) / len(x), 1e-9))
    for _ in range(steps):
        margin = target * (products @ of_row + bias)
        pull = share * target / (1 + np.exp(np.clip(margin, -30, 30)))
        of_row += rate * pull
        bias += rate * pull.sum(0)
    weights = x.T @ of_row
    full = np.zeros((BUCKETS, code.shape[1]), np.float32)
    full[used] = weights * scale[:, None]
    return CodeModel(names, code, full, bias.astype(np.float64))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from; a row without id counts as learnable."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> CodeModel:
    """Fit on at most ``sample_rows`` labelled rows of each language that are not held out."""
    usable = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"), F.octet_length(text_col).alias("n")
    )
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return fit(pa.array([], pa.string()), [])
    # the share of hashes that leaves at least the rows wanted, then the least ones: a sample of known size
    limits = {k: -(2**63) + int(2**64 * min(1.0, (4 * sample_rows + 40) / n)) - 1 for k, n in counts.items()}
    keep = F.lit(False)
    for k, top in limits.items():
        keep = keep | ((F.col("lang") == k) & (F.col("h") <= top))
    ids = sorted((r["lang"], r["n"] > 100_000, r["h"]) for r in usable.where(keep).select("lang", "h", "n").collect())
    chosen: dict[str, list[int]] = {}
    for lang, _, h in ids:
        if len(some := chosen.setdefault(lang, [])) < sample_rows:
            some.append(h)
    rows = usable.where(F.col("h").isin([h for some in chosen.values() for h in some])).select("lang", F.col("text")).collect()
    return fit(pa.array([r["text"] for r in rows], pa.string()), [r["lang"] for r in rows])


def identify(docs: DataFrame, model: CodeModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of each row, from its text alone."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = shared.value.decode(batch.column(2))
            columns = [batch.column(0), batch.column(1), pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            names = [id_col, "held_out", "lang_pred", "score"]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col))
    found = out.mapInArrow(predict, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
    return found.withColumn("ambiguous", F.col("score") < 0.5 + AMBIGUOUS)


def tagged(docs: DataFrame, model: CodeModel, text_col: str = "text") -> DataFrame:
    """(row, lang, score): each whole row as a struct beside its language."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        languages, scores = shared.value.decode(pa.array(texts, pa.string(), from_pandas=True))
        let_go()
        return pd.DataFrame({"lang": languages, "score": scores})

    # else a filter on the language moves below the struct and predicts every row a second time, in workers of its own
    once = predict.asNondeterministic()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), once(F.col(f"`{text_col}`")).alias("found"))
    return rows.select("row", F.col("found.lang").alias("lang"), F.col("found.score").alias("score"))
