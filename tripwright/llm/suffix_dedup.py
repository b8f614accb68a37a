"""Suffix-array dedup: a byte goes if a string of 50 bytes over it also starts in a document with a smaller id.

The suffixes that can match are found by anchors (``shared_windows``). Where their surroundings differ, the windows of
a bucket get a tag each, a hash of their bytes; a window whose tag no other has equals none. Of the others, neighbours
by tag that their bytes show to be equal are one suffix. These suffixes are sorted by a merge sort whose comparisons
are logarithmic: prefix polynomial hashes give the hash of any span, a binary search over span lengths gives the
longest common extension of two suffixes (up to 50 bytes), and the byte after it decides. A common extension is
confirmed by comparing the bytes; on a collision of hashes the bytes alone decide. Suffixes with a common extension of
50 stand together, and the least id among them keeps its bytes. The sort starts from an order by leading bytes, so that
few runs are left to merge. What stands beside a passage that many documents share differs in each of them, and all of
it meets in one anchor: there most windows are many times the same few or the only ones of their kind, and a sort of
all of them grew faster than their number.

Defined cases: a null text is empty; texts under 50 bytes stay; rows with one id don't remove each other's bytes; a
null id is less than all others; repeated rows give repeated results; empty tables give empty tables; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import NULL_ID
from tripwright.llm.shared_windows import Chosen, Context, WindowKind, shared_windows
from tripwright.llm.words import BASE, letter_values, mixed, power_tables

LENGTH = 50
GRAM = 24
#: Grams that are hashed at once; a gram's hash does not depend on where the hashing begins.
HASHED_AT_ONCE = 1 << 17
#: Windows whose tags are compared at once, unless one anchor has more at one place; suffixes that are sorted at once.
WINDOWS_AT_ONCE = 1 << 20
SORTED_AT_ONCE = 1 << 16


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable]:
    grams = np.empty(max(0, len(data) - GRAM + 1), np.uint64)
    for at in range(0, len(grams), HASHED_AT_ONCE):
        n = min(HASHED_AT_ONCE, len(grams) - at)
        prefix, inverse = prefix_hashes(data[at : at + n + GRAM - 1])
        grams[at : at + n] = mixed((prefix[GRAM : GRAM + n] - prefix[:n]) * inverse[:n])
    whole = data.tobytes()
    return grams, offsets, lambda a, b: whole[a:b]


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    powers, inverse = power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letter_values()[data] * powers[: len(data)], out=prefix[1:])
    return prefix, inverse


def windows_of(data: np.ndarray, length: int) -> np.ndarray:
    """All windows of some bytes, as items that overlap."""
    return np.ndarray((max(0, len(data) - length + 1),), f"V{length}", data, 0, (1,))


class Suffixes:
    """Suffixes of a text of which the first ``length`` bytes count; the text goes on at least that far."""

    def __init__(self, text: bytes, length: int) -> None:
        self.data = np.frombuffer(text, np.uint8)
        self.prefix, self.inverse = prefix_hashes(self.data)
        self.length = length

    def span(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[at + length] - self.prefix[at]) * self.inverse[at]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of pairs, up to the length that counts."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        while (low < high).any():
            half = (low + high + 1) >> 1
            equal = self.span(a, half) == self.span(b, half)
            low, high = np.where(equal, half, low), np.where(equal, high, np.minimum(high, half - 1))
        return self.verified(a, b, low)

    def verified(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Extensions confirmed by the bytes; the first difference counts where hashes collided."""
        out = length.copy()
        steps, rows = np.arange(self.length), windows_of(self.data, self.length)
        for at in range(0, len(a), 10_000):
            some = slice(at, at + 10_000)
            one, other = (rows[x[some]].view(np.uint8).reshape(-1, self.length) for x in (a, b))
            differ = (one != other) & (steps < length[some, None])
            bad = differ.any(1)
            out[some] = np.where(bad, differ.argmax(1), length[some])
        return out

    def leading(self, at: np.ndarray) -> list[np.ndarray]:
        """The first bytes of suffixes as whole numbers, the last of them first, to start the sort from."""
        words = self.length // 8
        some = np.empty((len(at), words * 8), np.uint8)
        for k in range(words * 8):
            some[:, k] = self.data[at + k]
        return list(some.view(">u8").astype(np.uint64).T[::-1])

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix ``a`` stands before ``b``."""
        common = self.extension(a, b)
        inside = np.minimum(common, self.length - 1)
        return np.where(common >= self.length, or_equal, self.data[a + inside] < self.data[b + inside])

    def sort(self, at: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Order of suffixes inside their parts (``part`` ascends): merges of runs of 1, 2, 4 and so on.

        Runs that follow each other already, which one comparison tells, are not merged.
        """
        n = len(at)
        order = np.arange(n)
        if not n:
            return order
        begin = np.flatnonzero(np.diff(part, prepend=part[0] - 1))
        size = np.diff(np.append(begin, n))
        own_begin, own_size = np.repeat(begin, size), np.repeat(size, size)
        inside = np.arange(n) - own_begin
        width, largest = 1, int(size.max())
        while width < largest:
            pair = inside // (2 * width) * (2 * width)
            left = (inside - pair) < width
            # the last of the left run against the first of the right one
            seam = np.flatnonzero(left & (inside - pair == width - 1) & (inside + 1 < own_size))
            apart = seam[~self.less(at[order[seam]], at[order[seam + 1]], True)]
            mixed_pair = np.zeros(n, bool)
            mixed_pair[own_begin[apart] + pair[apart]] = True
            merging = mixed_pair[own_begin + pair]
            if not len(apart):
                width *= 2
                continue
            # rank of an item among those of the other run, by binary search
            other = own_begin + pair + np.where(left, width, 0)
            low = np.minimum(other, own_begin + own_size)
            high = np.minimum(other + width, own_begin + own_size)
            first = low.copy()
            low = np.where(merging | left, low, high)  # of ordered runs the left one stands first
            active = np.flatnonzero(merging & (low < high))
            while len(active):
                half = (low[active] + high[active]) >> 1
                mine, theirs = at[order[active]], at[order[half]]
                goes = self.less(theirs, mine, False)
                ties = ~left[active]  # of equal suffixes those of the left run come first
                if ties.any():
                    some = np.flatnonzero(ties & ~goes)
                    goes[some] = self.less(theirs[some], mine[some], True)
                low[active] = np.where(goes, half + 1, low[active])
                high[active] = np.where(goes, high[active], half)
                active = active[low[active] < high[active]]
            # a place in the merged run: own place in the own run and the rank in the other
            own = np.where(left, inside - pair, inside - pair - width)
            target = own_begin + pair + own + (low - first)
            merged = np.empty_like(order)
            merged[target] = order
            order = merged
            width *= 2
        return order


def rows_at(units: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The windows that start at some places, a row each, in whole 8-byte words with zeros behind."""
    out = np.zeros((len(at), -(-length // 8) * 8), np.uint8)
    out[:, :length] = windows_of(units, length)[at].view(np.uint8).reshape(-1, length)
    return out.view(np.uint64)


def row_tags(rows: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A hash of each row and its seed."""
    out = mixed(seed)
    for word in rows.T:
        out = mixed((out ^ word) * np.uint64(BASE))
    return out


def known_twice(tags: np.ndarray) -> np.ndarray:
    """Order by tag of those that occur more than once."""
    order = np.argsort(tags, kind="stable")
    same = np.append(False, np.append(np.diff(tags[order]) == 0, False))
    return order[same[1:] | same[:-1]]


def same_windows(units: np.ndarray, at: np.ndarray, part: tuple[np.ndarray, ...], tags: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that some other equals, as places in ``at``, and the number of each one's class, which ascends.

    Equal windows have equal tags. Neighbours in the order of tags that their bytes show to be equal are one suffix of
    the sort, which brings together what is left apart.
    """
    order = known_twice(tags)
    if not len(order):
        return order, order
    new = np.ones(len(order), bool)
    for k in range(0, len(order) - 1, SORTED_AT_ONCE):
        some = order[k : k + SORTED_AT_ONCE + 1]
        rows = rows_at(units, at[some], length)
        differ = (rows[1:] != rows[:-1]).any(1)
        for x in part:
            differ |= x[some[1:]] != x[some[:-1]]
        new[k + 1 : k + len(some)] = differ
    heads = np.flatnonzero(new)
    of_head = np.empty(len(heads), np.int64)
    # no class goes beyond a tag, so that some tags at a time are sorted
    tag = tags[order[heads]]
    ends = np.append(np.flatnonzero(tag[1:] != tag[:-1]) + 1, len(heads))
    lo = 0
    while lo < len(heads):
        hi = int(ends[max(np.searchsorted(ends, lo + SORTED_AT_ONCE, "right") - 1, np.searchsorted(ends, lo, "right"))])
        first = order[heads[lo:hi]]
        of_head[lo:hi] = lo + suffix_classes(units, at[first], [x[first] for x in part], length)
        lo = hi
    number = np.repeat(of_head, np.diff(np.append(heads, len(order))))
    again = np.argsort(number, kind="stable")
    return order[again], number[again]


def suffix_classes(units: np.ndarray, at: np.ndarray, part: list[np.ndarray], length: int) -> np.ndarray:
    """A number for each suffix, equal for equal ones of one part: by their order, and extensions of neighbours."""
    suffixes, own = Suffixes(windows_of(units, length)[at].tobytes(), length), np.arange(len(at)) * length
    order = np.lexsort([*suffixes.leading(own), *part])
    changes = np.zeros(len(at) - 1, bool)
    for x in part:
        changes |= x[order[1:]] != x[order[:-1]]
    parts = np.cumsum(np.append(True, changes))
    sorted_ = suffixes.sort(own[order], parts)
    order, parts = order[sorted_], parts[sorted_]
    new = np.ones(len(at), bool)
    near = np.flatnonzero(parts[1:] == parts[:-1])
    new[near + 1] = suffixes.extension(own[order[near]], own[order[near + 1]]) < length
    out = np.empty(len(at), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def arrays_of(contexts: Sequence[Context]) -> tuple[np.ndarray, ...]:
    """Units, and starts in them, keys, least ids, windows and places of anchors."""
    if isinstance(contexts, Chosen):
        return contexts.arrays()
    starts = np.cumsum([0, *(len(c.units) for c in contexts)])[:-1]
    columns = [np.array([getattr(c, x) for c in contexts], kind) for x, kind in (("key", np.uint64), ("least", np.int64), ("windows", np.int64), ("anchor", np.int64))]
    return np.frombuffer(b"".join(c.units for c in contexts), np.uint8), starts, *columns


def resolve(contexts: Sequence[Context], length: int = LENGTH) -> list[int]:
    """Removed windows of contexts, by sorting the suffixes at all their windows.

    Equal windows hold their anchor at one place, so that windows are compared by the place of it, some places at a time.
    """
    units, starts, keys, least, windows, anchors = arrays_of(contexts)
    masks = np.zeros(len(keys), np.uint64)
    if not len(keys):
        return []
    least_ahead = int((anchors - windows).min()) + 1
    places = int(anchors.max()) + 1 - least_ahead
    lots = min(places, -(-int(windows.sum()) // WINDOWS_AT_ONCE))
    for lo, hi in ((least_ahead + places * k // lots, least_ahead + places * (k + 1) // lots) for k in range(lots)):
        begin = np.maximum(0, anchors - hi + 1)
        counts = np.maximum(0, np.minimum(windows, anchors - lo + 1) - begin)
        owner = np.repeat(np.arange(len(keys), dtype=np.int32), counts)
        inside = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts - begin, counts)).astype(np.int16)
        at = starts[owner] + inside
        part = (anchors[owner] - inside, keys[owner])
        tags = np.empty(len(at), np.uint64)
        for k in range(0, len(at), SORTED_AT_ONCE):
            some = slice(k, k + SORTED_AT_ONCE)
            tags[some] = row_tags(rows_at(units, at[some], length), part[1][some] << np.uint64(16) ^ part[0][some].astype(np.uint64))
        found, number = same_windows(units, at, part, tags, length)
        if not len(found):
            continue
        ids = least[owner[found]]
        first = np.flatnonzero(np.diff(number, prepend=-1))
        gone = found[ids > np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(ids))))]
        np.bitwise_or.at(masks, owner[gone], np.uint64(1) << inside[gone].astype(np.uint64))
    return masks.tolist()


def finish(text: bytes, removed: np.ndarray | None) -> bytes:
    return text if removed is None else np.frombuffer(text, np.uint8)[~removed].tobytes()


KIND = WindowKind(LENGTH, GRAM, byte_grams, finish, resolve)


def drop_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept); ``kept`` has the bytes where some were removed."""
    out = shared_windows(docs, KIND, id_col, text_col, **options)
    known = F.when(F.col("id") != NULL_ID, F.col("id")).cast(docs.schema[id_col].dataType)
    return out.select(known.alias(id_col), F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256", "kept")
