"""Byte-level BPE with a pair occurrence index.

The different words of a batch lie one after another in one array of symbols. An index maps each pair that has
a merge rule to all positions where it stands. The ranks that are in use are applied in ascending order: a rank
takes its positions from the index, joins each pair that still stands there, and enters the two new pairs beside
it under their own ranks. Words are independent of each other, so that the order over the whole batch is, for
each word, the order of its own ranks.

Defined cases: a null text counts as empty and has no tokens; an empty text has no tokens; repeated rows give
repeated results; an empty table gives an empty table. Words are looked up in a bounded cache per worker, which
has no influence on results.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripwright.llm.common import bounded_batches, sha256_hex, texts_of

#: How byte-level BPE cuts a text into words: the public pattern, and the same for texts of ASCII only.
WORDS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
ASCII_WORDS = re.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\x09-\x0d\x20A-Za-z0-9]+|[\x09-\x0d\x20]+(?![^\x09-\x0d\x20])|[\x09-\x0d\x20]+"""
)
#: The same for texts whose characters are all below U+0100, with their letters, numbers and spaces spelled out.
LATIN_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPACES = r"\x09-\x0d\x20\x85\xa0"
LATIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN_LETTERS}]+| ?[{LATIN_NUMBERS}]+| ?[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]+"
    f"|[{LATIN_SPACES}]+(?![^{LATIN_SPACES}])|[{LATIN_SPACES}]+"
)
#: Words kept per worker, and the longest word that is kept.
CACHE_WORDS = 600_000
CACHE_LENGTH = 48


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class PairIndexBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        of_char = byte_symbols()
        suffix = spec["model"].get("end_of_word_suffix") or ""
        as_bytes = lambda token: bytes(of_char[c] for c in token.removesuffix(suffix))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: as_bytes(token) for token, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        in_order = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.token_size = np.array([len(x) for x in in_order], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_data = np.frombuffer(b"".join(in_order), np.uint8)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.byte_id, self.last_id = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for char, byte in of_char.items():
            self.byte_id[byte] = vocab[char]
            self.last_id[byte] = vocab[char + suffix]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        keys = np.array([(a << 32) | b for a, b, _ in self.rules], np.int64)
        order = np.argsort(keys)
        self.sorted_keys, self.sorted_ranks = keys[order], order
        self.cache: dict[str, bytes] = {}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where no rule has it."""
        keys = (left.astype(np.int64) << 32) | right
        place = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.sorted_keys) - 1)
        return np.where(self.sorted_keys[place] == keys, self.sorted_ranks[place], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        joined = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        symbols = self.byte_id[joined]
        symbols[ends - 1] = self.last_id[joined[ends - 1]]
        symbols[ends] = -1  # no rule has it: pairs never reach over the end of a word
        after = np.arange(1, len(symbols) + 1, dtype=np.int32)
        before = np.arange(-1, len(symbols) - 1, dtype=np.int32)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            """Put positions into the index under their ranks."""
            if len(keep := np.flatnonzero(ranks >= 0)) == 0:
                return
            ranks, positions = ranks[keep], positions[keep]
            if len(ranks) > 1:
                order = np.argsort(ranks, kind="stable")
                ranks, positions = ranks[order], positions[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for x, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
                if (lists := index.get(x)) is None:
                    index[x] = [positions[a:b]]
                    heappush(active, x)
                else:
                    lists.append(positions[a:b])

        enter(np.arange(len(symbols) - 1, dtype=np.int32), self.ranks_of(symbols[:-1], symbols[1:]))
        while active:
            rank = heappop(active)
            left, right, merged = self.rules[rank]
            lists = index.pop(rank)
            i = lists[0] if len(lists) == 1 else np.concatenate(lists)
            j = after[i]
            i = i[(symbols[i] == left) & (symbols[np.minimum(j, len(symbols) - 1)] == right)]
            if len(lists) > 1:
                i = np.unique(i)
            if left == right:
                i = self.without_overlaps(i, after)
            if not len(i):
                continue
            j = after[i]
            k, p = after[j], before[i]
            symbols[i], symbols[j] = merged, -2
            after[i] = k
            before[k] = i  # a word's end follows at the latest
            beside = np.maximum(p, 0)
            pairs = self.ranks_of(
                np.concatenate([np.where(p >= 0, symbols[beside], -1), symbols[i]]),
                np.concatenate([symbols[i], symbols[k]]),
            )
            enter(np.concatenate([beside, i]), pairs)
        live = symbols >= 0
        ids = symbols[live].astype("<u4").tobytes()
        cuts = (np.cumsum(live)[ends] * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    @staticmethod
    def without_overlaps(i: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of pairs of equal symbols in a row, every other one from the left."""
        if len(i) < 2:
            return i
        follows = np.concatenate([[False], after[i[:-1]] == i[1:]])
        starts = np.maximum.accumulate(np.where(follows, 0, np.arange(len(i))))
        return i[(np.arange(len(i)) - starts) % 2 == 0]

    def pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens stand alone."""
        if text.isascii():
            cut = ASCII_WORDS.findall
        else:
            cut = LATIN_WORDS.findall if is_latin(text) else WORDS.findall
        if not self.special or not any(s in text for s in self.special):
            return cut(text)
        return [w for part in self.split.split(text) for w in ([part] if part in self.special else cut(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        pieces = [self.pieces(text) for text in texts]
        known = self.cache
        found = [list(map(known.get, words)) for words in pieces]
        gaps = [[k for k, x in enumerate(ids) if x is None] if None in ids else [] for ids in found]
        new = list({words[k] for words, at in zip(pieces, gaps, strict=True) for k in at} - self.special.keys())
        learned = dict(zip(new, self.encode_words([w.encode() for w in new]), strict=True))
        learned |= {w: np.uint32(i).astype("<u4").tobytes() for w, i in self.special.items()}
        for words, ids, at in zip(pieces, found, gaps, strict=True):
            for k in at:
                ids[k] = learned[words[k]]
        room = CACHE_WORDS - len(known)
        if room > 0:  # the common words come early
            known.update(islice(((w, x) for w, x in learned.items() if len(w) <= CACHE_LENGTH), room))
        return [b"".join(ids) for ids in found]

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special tokens included; bytes that are no UTF-8 become the replacement character."""
        ids = np.frombuffer(ids, "<u4")
        sizes = self.token_size[ids]
        total = int(sizes.sum())
        shift = self.token_start[ids] - (np.cumsum(sizes) - sizes)
        return self.token_data[np.repeat(shift, sizes) + np.arange(total)].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> PairIndexBpe:
    """One encoder per worker and vocabulary."""
    return PairIndexBpe(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded, ids_sha256, decoded_sha256) of each row, one pass without a shuffle.

    ``ids`` and ``decoded`` are left out unless ``with_ids``. ``path`` has to be readable on the executors.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    extra = ", ids array<long>, decoded string" if with_ids else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            encoded = bpe.encode(texts_of(batch.column(1)))
            decoded = [bpe.decode(x) for x in encoded]
            columns = {
                id_col: batch.column(0),
                "n_tokens": pa.array([len(x) // 4 for x in encoded], pa.int64()),
                "ids_sha256": pa.array([sha256_hex(x) for x in encoded], pa.string()),
                "decoded_sha256": pa.array([sha256_hex(x.encode()) for x in decoded], pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in encoded], pa.list_(pa.int64()))
                columns["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}"
    return docs.select(id_col, text_col).mapInArrow(encode, schema)
