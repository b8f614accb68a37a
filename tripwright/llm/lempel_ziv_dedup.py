"""Substring dedup by relative Lempel-Ziv parsing: a word goes if a window of 13 words over it also starts in a
document with a smaller id.

Reference blocks are the contexts that share an anchor (``shared_windows``), so that every window which could match
lies in one block. A context is factored greedily against the block of those with smaller ids: the block's index
has the next 13 words and a tree of what follows them, the longest way down is the factor, and all its windows are
duplicates. Windows across the end of a factor are looked up one by one, as a factor of another reference may cover
them. The context then joins the block.

Defined cases: a null or empty text has no words; texts with fewer than 13 words stay; rows with one id don't remove
each other's words; a null id is less than all others; repeated rows give repeated results; empty tables give empty
tables; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import NULL_ID
from tripwright.llm.shared_windows import Context, WindowKind, shared_windows
from tripwright.llm.words import run_hashes, word_hashes, word_places

LENGTH = 13
GRAM = 7


def word_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable]:
    starts, ends, first = word_places(data, offsets)
    grams = run_hashes(word_hashes(data, starts, ends), GRAM)
    whole = data.tobytes()
    return grams, first, lambda a, b: b" ".join(whole[starts[a] : ends[b - 1]].split())


class ReferenceBlock:
    """Contexts with an index of all their windows; each leads to a tree of what follows it somewhere."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.index: dict[tuple[bytes, ...], dict] = {}
        self.known: set[tuple[bytes, ...]] = set()

    def add(self, words: tuple[bytes, ...]) -> None:
        if words in self.known:
            return
        self.known.add(words)
        for at in range(len(words) - self.length + 1):
            tree = self.index.setdefault(words[at : at + self.length], {})
            for word in words[at + self.length :]:
                tree = tree.setdefault(word, {})

    def factor(self, words: tuple[bytes, ...], at: int) -> int:
        """Words of the longest factor at a place; 0 if it is shorter than a window."""
        tree = self.index.get(words[at : at + self.length])
        if tree is None:
            return 0
        n = self.length
        for word in words[at + n :]:
            if (tree := tree.get(word)) is None:
                break
            n += 1
        return n

    def parse(self, words: tuple[bytes, ...]) -> int:
        """Mask of the windows that factors cover."""
        mask, at = 0, 0
        while at + self.length <= len(words):
            n = self.factor(words, at)
            if n:
                covered = n - self.length + 1
                mask |= ((1 << covered) - 1) << at
                at += covered  # the next windows reach over the factor's end
            else:
                at += 1
        return mask


def resolve(contexts: Sequence[Context], length: int = LENGTH) -> list[int]:
    """Removed windows of contexts, by parsing each against those with smaller ids."""
    contexts = list(contexts)
    masks = [0] * len(contexts)
    order = sorted(range(len(contexts)), key=lambda p: (contexts[p].key, contexts[p].least))
    for _, places in groupby(order, key=lambda p: contexts[p].key):
        block = ReferenceBlock(length)
        for _, same in groupby(places, key=lambda p: contexts[p].least):
            some = [(p, tuple(contexts[p].units.split(b" "))) for p in same]
            for p, words in some:
                masks[p] = block.parse(words)
            for _, words in some:
                block.add(words)
    return masks


def finish(text: bytes, removed: np.ndarray | None) -> bytes:
    words = text.split()
    return b" ".join(words if removed is None else [w for w, gone in zip(words, removed.tolist(), strict=True) if not gone])


KIND = WindowKind(LENGTH, GRAM, word_grams, finish, resolve)


def drop_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept); ``kept`` has the words where some were removed."""
    out = shared_windows(docs, KIND, id_col, text_col, **options)
    known = F.when(F.col("id") != NULL_ID, F.col("id")).cast(docs.schema[id_col].dataType)
    return out.select(known.alias(id_col), F.col("n_units").alias("n_words"), "n_removed", "kept_sha256", "kept")
