"""Packing of documents into sequences: shortest pack first over the histogram of lengths.

A document's ids end with one separator id. Longer documents are cut into full sequences and a rest. The counts
of the rests' lengths (at most ``SEQUENCE`` different ones, whatever the size of the corpus) are packed longest
first: a length goes to the fullest-fitting open packs last, to the shortest pack first, and whole pattern counts
move at once, so that the work grows with the number of different lengths and not with the documents. The patterns
are joined back by the rank of a piece among those of its length.

Ranks come from counts per (length, block of ids) and row numbers inside a block, so that a length which holds
many rows is spread over the blocks.

Defined cases: a null text is empty and has the separator alone; every row is packed, repeated rows too (their
pieces are ranked by id, start and a row key); an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.bpe import LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES, PairIndexBpe, is_latin
from tripwright.llm.common import BATCH_BYTES, bounded_batches, checkpointed, let_go, partitions, texts_of

#: How the vocabulary's file cuts lower-case texts of characters below U+0100; letters come first because most parts are letters.
PARTS = re.compile(f"[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]+")
SEQUENCE = 4096
SEPARATOR = 2
#: Parts of texts kept per worker during a task; words of other texts, and after a task both together.
CACHE_PARTS = 400_000
CACHE_WORDS = 150_000
CACHE_LENGTH = 48
#: Characters of texts that are encoded at once, a whole batch as a rule: a call goes through all merge ranks that its new
#: words use, so that four calls cost nearly four times as much as one.
STRETCH = BATCH_BYTES


class WordIds:
    """Ids of texts as the public tokenizers library gives them, remembered in bounded caches.

    The normaliser composes characters, folds runs of white space and lowers letters, and no token reaches over
    white space or out of a part that the public pattern cuts. Texts of characters below U+0100 are cut by that
    pattern as a whole, and their parts are merged by ``PairIndexBpe``; the library itself encodes the white-space
    words of all others.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.bpe = PairIndexBpe(path)
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self) -> object:
        """The library's tokenizer, loaded when a word first asks for it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def by_library(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4").tobytes()
        cuts = (np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(words) + 1)) * 4).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [is_latin(t) and not any(s in t for s in self.bpe.special) for t in texts]
        cut = [
            PARTS.findall(t.lower()) if simple else t.replace("\n", " ").replace("\t", " ").split(" ")
            for t, simple in zip(texts, plain, strict=True)
        ]
        parts, words = self.parts, self.words
        new = list(set().union(*(x for x, simple in zip(cut, plain, strict=True) if simple)).difference(parts))
        parts.update(zip(new, self.bpe.encode_words([x.encode() for x in new]), strict=True))
        others = list(set().union(*(x for x, simple in zip(cut, plain, strict=True) if not simple)).difference(words))
        for at in range(0, len(others), 5_000):
            words.update(zip(others[at : at + 5_000], self.by_library(others[at : at + 5_000]), strict=True))
        out = [b"".join(map((parts if simple else words).__getitem__, x)) for x, simple in zip(cut, plain, strict=True)]
        bounded(parts, new, CACHE_PARTS)
        bounded(words, others, CACHE_WORDS)
        return out

    def shrink(self) -> None:
        """Keep the first parts only, which are the common ones, and no more than the words leave room for."""
        self.parts = dict(islice(self.parts.items(), max(0, CACHE_WORDS - len(self.words))))


def bounded(known: dict[str, bytes], new: list[str], most: int) -> None:
    """Drop what is long of the new entries, and the last of the others above ``most``: the common ones come early."""
    for x in new:
        if len(x) > CACHE_LENGTH:
            del known[x]
    while len(known) > most:
        known.popitem()


def stretches(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, some at a time; a longer text stands alone."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > STRETCH:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``sequence`` ids: (doc_id, start, length, ids_crc32, doc_tokens[, ids])."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        encoder = word_ids(path)
        end = np.uint32(SEPARATOR).astype("<u4").tobytes()
        for batch in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for row, encoded in enumerate(x for some in stretches(texts_of(batch.column(1))) for x in encoder.encode(some)):
                encoded += end
                n = len(encoded) // 4
                for at in range(0, n, sequence):
                    piece = encoded[at * 4 : (at + sequence) * 4]
                    rows.append(row)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int64))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        encoder.shrink()  # the worker lives on and serves other stages
        let_go()

    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold the same lengths in the same order."""

    lengths: tuple[int, ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[Pattern]:
    """Patterns that hold exactly the counted lengths, none longer than ``sequence``.

    Lengths are placed longest first. ``open_packs[r]`` holds the pattern counts with ``r`` ids left; a length
    goes to the pack with the most room, that is the shortest, and opens new packs for what finds no room.
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_packs if r >= length), default=None)
            if room is None:
                per_pack = sequence // length
                for times, packs in ((per_pack, left // per_pack), (left % per_pack, 1)):
                    if times and packs:
                        open_packs[sequence - times * length].append(((length,) * times, packs))
                break
            lengths, count = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            used = min(left, count)
            left -= used
            if used < count:
                open_packs[room].append((lengths, count - used))
            open_packs[room - length].append(((*lengths, length), used))
    found = [Pattern(lengths, count) for packs in open_packs.values() for lengths, count in packs]
    return sorted(found, key=lambda p: p.lengths, reverse=True)


def slots(patterns: list[Pattern]) -> dict[int, list[tuple[int, int, int]]]:
    """By length, in order of rank: (first rank, first sequence, offset) of each place a pattern has for it."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    first = 0
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            out[length].append((taken[length], first, offset))
            taken[length] += pattern.count
            offset += length
        first += pattern.count
    return out


def ranked(pieces: DataFrame, id_col: str, blocks: int) -> DataFrame:
    """Add ``_rank``, from 0, of each piece among those of its length."""
    keyed = pieces.withColumn("_block", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(blocks)))
    counts = keyed.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("length").alias("_length"), F.col("_block").alias("_of"), F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_block").orderBy(id_col, "start", "ids_crc32")
    return (
        keyed.withColumn("_row", F.row_number().over(inside) - 1)
        .join(offsets, (F.col("length") == F.col("_length")) & (F.col("_block") == F.col("_of")))
        .withColumn("_rank", F.col("_row") + F.col("_before"))
        .drop("_block", "_of", "_length", "_row", "_before")
    )


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``; see the module's text."""
    pieces = checkpointed(cut_pieces(docs, path, id_col, text_col, sequence, with_ids))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, sequence))
    columns = [*pieces.columns, "sequence_id", "offset"]
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"`{c}` {kinds.get(c, 'long')}" for c in columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = {length: np.array(x, np.int64) for length, x in table.items()}
        for batch in batches:
            lengths, ranks = (np.asarray(batch.column(c)) for c in ("length", "_rank"))
            sequences, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                of = arrays[int(lengths[at[0]])]
                slot = np.searchsorted(of[:, 0], ranks[at], side="right") - 1
                sequences[at] = of[slot, 1] + ranks[at] - of[slot, 0]
                offsets[at] = of[slot, 2]
            kept = [batch.column(c) for c in columns[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequences), pa.array(offsets)], columns)

    return ranked(pieces, id_col, partitions(docs.sparkSession)).mapInArrow(place, schema)
