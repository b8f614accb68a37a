"""Which windows of units (bytes, words) of a document also start in a document with a smaller id.

Equal windows choose equal anchors: of the ``q``-grams of a window the one with the least hash, the first of equal
ones. The windows of a document that share an anchor make a run; its units are the run's context. So only contexts
with equal anchors have to be compared, and only where an anchor stands in several documents.

1. Documents are dealt to groups of bounded size by a hash of the id. A group sends each different anchor once, to
   the anchor's bucket, as packed arrays; a bucket tells its groups which anchors several documents hold.
2. A group sends each different context of such anchors once, with the least id that has it.
3. A bucket decides for the windows of each context whether a smaller id has them: contexts that are equal
   everywhere by their least id alone, all others by the operator's own method (``resolve``).
4. A group applies the answers to its documents.

A passage that a third of all documents share is thus one row for each group and not one for each document. Texts are
shuffled twice, to the same groups: for steps 1 and 2, whose shuffle is let go when the contexts are written, and for
step 4, after the answers are written and the shuffle of contexts is let go. What is written holds contexts, the places
of runs and answers, packed, but no whole text. Anchors are compared by hash, contexts by their units, so that equal
hashes alone remove nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import NULL_ID, bounded_batches, input_bytes, let_go, sha256_hex, text_bytes, written
from tripwright.llm.words import least_places, mixed

#: Text bytes of one group, and of one stretch that is worked on at once.
GROUP_BYTES = 8 << 20
STRETCH = 1 << 20
#: Contexts that a bucket hands to ``resolve`` at once, which bounds what it holds; one anchor stays whole.
RESOLVED_AT_ONCE = 4_000
#: Lots in which a group works its buckets off, which bounds the contexts that it holds; anchors compared at once.
LOTS = 4
COMPARED_AT_ONCE = 20_000
#: Above so many buckets, a bucket has as much as so many groups.
LEAST_BUCKETS = 96
GROUPS_A_BUCKET = 3


@dataclass(frozen=True)
class Context:
    """A run of windows with one anchor: its units as bytes, the least id that has it, windows, anchor's place."""

    key: int
    units: bytes
    least: int
    windows: int
    anchor: int


@dataclass(frozen=True)
class WindowKind:
    """What a window is made of.

    ``grams(data, offsets)`` gives the hash of each ``q``-gram of units, the first unit of each text, and a function
    that gives the units from one to another as bytes. ``finish(text, removed)`` gives the kept bytes.
    ``resolve(contexts)`` takes contexts of one bucket with equal anchors that differ, and gives a mask of removed
    windows for each.
    """

    width: int
    q: int
    grams: Callable
    finish: Callable
    resolve: Callable


@dataclass(frozen=True)
class Runs:
    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    anchor: np.ndarray

    def at(self, places: np.ndarray) -> Runs:
        """Some of the runs, in half the space."""
        doc, start, windows, anchor = (x[places].astype(np.int32) for x in (self.doc, self.start, self.windows, self.anchor))
        return Runs(doc, start, windows, self.key[places], anchor)


def runs_of(kind: WindowKind, grams: np.ndarray, first: np.ndarray) -> Runs:
    """Runs of the texts of one stretch; starts count from the stretch."""
    ends = np.repeat(first[1:] - kind.width, np.diff(first))
    places = least_places(grams, kind.width - kind.q + 1)
    at = np.flatnonzero(ends[: len(places)] >= np.arange(len(places)))
    if not len(at):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none)
    anchor = places[at]
    begin = np.flatnonzero(np.diff(anchor, prepend=-1))
    start = at[begin]
    windows = np.diff(np.append(begin, len(at)))
    # a least hash is small: mixed again, keys are even over the buckets
    return Runs(np.searchsorted(first, start, "right") - 1, start, windows, mixed(grams[anchor[begin]]), anchor[begin] - start)


def stretches(kind: WindowKind, texts: pa.Array) -> Iterator[tuple[int, Runs, np.ndarray, Callable]]:
    """Runs of a group, a bounded number of texts at a time."""
    data, offsets = text_bytes(texts)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STRETCH, "right")) - 1)
        part = data[offsets[at] : offsets[to]]
        grams, first, cut = kind.grams(part, offsets[at : to + 1] - offsets[at])
        yield at, runs_of(kind, grams, first), first, cut
        at = to


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def short(keys: np.ndarray) -> np.ndarray:
    """31 bits of a key, which tell anchors of a bucket apart well enough to choose candidates."""
    return (keys & np.uint64(0xFFFFFFFE)).astype(np.uint32)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array; it is searched and not sorted again for each call."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def bucket_count(groups: int) -> int:
    """Fewer buckets than groups where there are many: each group sends each bucket a row, packed for itself."""
    return min(groups, max(LEAST_BUCKETS, groups // GROUPS_A_BUCKET))


def in_buckets(buckets: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets that occur, with the places of their items."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.searchsorted(buckets[order], np.arange(count + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b] : cuts[b + 1]]


def binary(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return column.to_pylist()


def packed(parts: Iterable[bytes]) -> bytes:
    """Contexts of one bucket overlap and share words, so that they are packed before they are shuffled."""
    return pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


#: Bytes of a context's key and anchor in front of its units.
HEAD = 10


class GroupContexts:
    """The different contexts of a group and the runs of its documents, in ascending order of ids.

    A context is one ``bytes``, its key and anchor in front of its units; all else about contexts and runs is in
    arrays, as a group can have a run for each dozen of its units.
    """

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.places: dict[bytes, int] = {}
        self.columns: list[np.ndarray] = []  # by stretch: key, least id, windows, anchor of contexts that are new in it
        self.runs: list[np.ndarray] = []  # by stretch: document, start, windows, bucket, context of runs
        self.owners: list[np.ndarray] = []

    def add(self, runs: Runs, hit: np.ndarray, docs: np.ndarray, starts: np.ndarray, owners: np.ndarray, cut: Callable, width: int) -> None:
        """Runs at ``hit`` of one stretch, with the documents, the starts inside them and the ids that they have."""
        if not len(hit):
            return
        begin, windows, keys, anchors = runs.start[hit], runs.windows[hit], runs.key[hit], runs.anchor[hit]
        heads = np.empty((len(hit), HEAD), np.uint8)
        heads[:, :8] = keys.astype("<u8").view(np.uint8).reshape(-1, 8)
        heads[:, 8:] = anchors.astype("<u2").view(np.uint8).reshape(-1, 2)
        head, places, before = heads.tobytes(), self.places, len(self.places)
        of_run = np.empty(len(hit), np.int64)
        for k, (a, b) in enumerate(zip(begin.tolist(), (begin + windows + width - 1).tolist(), strict=True)):
            of_run[k] = places.setdefault(head[k * HEAD : (k + 1) * HEAD] + cut(a, b), len(places))
        seen, first = np.unique(of_run, return_index=True)
        new = first[seen >= before]
        self.columns.append(np.stack([keys[new].view(np.int64), owners[new], windows[new], anchors[new]]))
        self.runs.append(np.stack([docs, starts, windows, bucket_of(keys, self.buckets), of_run]).astype(np.int32))
        self.owners.append(owners)

    def packed(self) -> tuple[list[tuple[int, int, bytes, bytes]], np.ndarray, np.ndarray]:
        """(bucket, number, units, the rest column by column) of each bucket; documents of runs; start, windows, bucket, place of runs."""
        if not self.runs:
            return [], np.zeros(0, np.int32), np.zeros((4, 0), np.int32)
        key, least, windows, anchor = np.concatenate(self.columns, 1)
        key, heads = key.view(np.uint64), list(self.places)
        sizes = np.fromiter(map(len, heads), np.int32, len(heads)) - np.int32(HEAD)
        place = np.zeros(len(heads), np.int32)
        sent = []
        for b, at in in_buckets(bucket_of(key, self.buckets), self.buckets):
            place[at] = np.arange(len(at))
            columns = (short(key[at]), least[at], (windows[at] << 16 | anchor[at]).astype(np.int32), sizes[at])
            sent.append((b, len(at), packed(heads[k][HEAD:] for k in at.tolist()), packed(c.tobytes() for c in columns)))
        runs, owner = np.concatenate(self.runs, 1), np.concatenate(self.owners)
        # -1: a smaller id of this group has the whole run
        runs[4] = np.where(owner > least[runs[4]], -1, place[runs[4]])
        return sent, runs[0], runs[1:]


def contexts_of(held: list[tuple[int, Runs, np.ndarray, Callable]], ids: np.ndarray, buckets: int, width: int) -> tuple[list, np.ndarray, np.ndarray]:
    """``GroupContexts.packed`` of a group, given as (first document, runs, first units, cut) of its stretches, a lot of buckets at a time."""
    sent: list[tuple[int, int, bytes, bytes]] = []
    docs, places = [np.zeros(0, np.int32)], [np.zeros((4, 0), np.int32)]
    for lot in range(LOTS):
        found = GroupContexts(buckets)
        for at, runs, first, cut in held:
            hit = np.flatnonzero(bucket_of(runs.key, buckets) * LOTS // buckets == lot)
            doc = runs.doc[hit]
            found.add(runs, hit, at + doc, runs.start[hit] - first[doc], ids[at + doc], cut, width)
        some, doc, place = found.packed()
        sent += some
        docs.append(doc)
        places.append(place)
    doc = np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return sent, doc[order], np.concatenate(places, 1)[:, order]


class Contexts:
    """The contexts of one bucket, as arrays over their joined units; a context is an object only while it is resolved.

    31 bits of a key are enough to hold those of a bucket together, as their units decide.
    """

    def __init__(self, rows: Iterable[tuple[int, bytes | pa.Buffer, bytes | pa.Buffer]]) -> None:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        contents = []
        self.counts = []
        for count, content, rest in rows:
            data, at = unpacked(rest, count * 20), 0
            for column, kind in zip(columns, (np.uint32, np.int64, np.int32, np.int32), strict=True):
                column.append(np.frombuffer(data, kind, count, at))
                at += count * np.dtype(kind).itemsize
            contents.append(content)
            self.counts.append(count)
        lengths = [int(x.sum()) for x in columns[3]]
        self.keys, self.least, self.shape, sizes = map(np.concatenate, columns)
        # unpacked one after another into their place, so that no unit is held twice
        self.units = memoryview(bytearray(sum(lengths)))
        at = 0
        for content, length in zip(contents, lengths, strict=True):
            self.units[at : at + length] = unpacked(content, length)
            at += length
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def cut(self, place: int) -> bytes:
        return self.units[self.starts[place] : self.ends[place]].tobytes()

    def context(self, place: int) -> Context:
        shape = int(self.shape[place])
        return Context(int(self.keys[place]), self.cut(place), int(self.least[place]), shape >> 16, shape & 0xFFFF)

    def masks(self, resolve: Callable) -> np.ndarray:
        """Removed windows of each context: by the least id where all contexts of an anchor are equal, else resolved."""
        order = np.argsort(self.keys, kind="stable")
        keys, least, shape = self.keys[order], self.least[order], self.shape[order]
        new = np.ones(len(order), bool)
        new[1:] = keys[1:] != keys[:-1]
        begin = np.flatnonzero(new)
        lows, highs = np.minimum.reduceat(shape, begin), np.maximum.reduceat(shape, begin)
        units, cuts = self.units.obj, np.append(begin, len(order))
        sizes = np.diff(cuts)
        equal = lows == highs
        several = np.flatnonzero(equal & (sizes > 1))
        for some in (several[k : k + COMPARED_AT_ONCE] for k in range(0, len(several), COMPARED_AT_ONCE)):
            base, stop = int(cuts[some[0]]), int(cuts[some[-1] + 1])
            starts, ends = self.starts[order[base:stop]].tolist(), self.ends[order[base:stop]].tolist()
            for g, at, to in zip(some.tolist(), (cuts[some] - base).tolist(), (cuts[some + 1] - base).tolist(), strict=True):
                one = units[starts[at] : ends[at]]
                for p in range(at + 1, to):
                    if units[starts[p] : ends[p]] != one:
                        equal[g] = False
                        break
        gone = np.repeat(equal, sizes) & (least > np.repeat(np.minimum.reduceat(least, begin), sizes))
        out = np.zeros(len(order), np.uint64)
        out[order[gone]] = (np.uint64(1) << (shape[gone] >> 16).astype(np.uint64)) - np.uint64(1)
        rest: list[np.ndarray] = []
        differing, held = np.flatnonzero(~equal).tolist(), 0
        for g in differing:
            rest.append(order[cuts[g] : cuts[g + 1]])
            held += len(rest[-1])
            if held >= RESOLVED_AT_ONCE or g == differing[-1]:  # anchors are independent of each other
                places = np.concatenate(rest)
                out[places] = np.array(resolve(Chosen(self, places)), np.uint64)
                rest.clear()
                held = 0
        return out


class Chosen(Sequence):
    """Some contexts of a bucket: objects one by one, arrays all together."""

    def __init__(self, bucket: Contexts, places: np.ndarray) -> None:
        self.bucket, self.places = bucket, places

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, k: int) -> Context:
        return self.bucket.context(int(self.places[k]))

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Units of the bucket, and starts in them, keys, least ids, windows and places of anchors."""
        bucket, at = self.bucket, self.places
        shape = bucket.shape[at].astype(np.int64)
        return np.frombuffer(bucket.units, np.uint8), bucket.starts[at], bucket.keys[at].astype(np.uint64), bucket.least[at], shape >> 16, shape & 0xFFFF


def concatenated(column: pa.ChunkedArray) -> pa.Array:
    """One array of a column of strings, with long offsets."""
    column = column.cast(pa.large_string())
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def groups_of(docs: DataFrame, id_col: str, text_col: str, groups: int) -> DataFrame:
    """(grp, id, t, text); rows with one id share a group, and ``t``, a hash of the text, tells them apart."""
    key, text = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("grp"), key.alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))


def shared_windows(docs: DataFrame, kind: WindowKind, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(id, n_units, n_removed, n_spans, kept_sha256, kept) of each row; ``kept`` where something was removed."""
    bounded_batches(docs.sparkSession)
    groups = max(1, -(-input_bytes(docs, text_col) // group_bytes))
    buckets = bucket_count(groups)
    texts = groups_of(docs, id_col, text_col, groups)

    def anchors(table: pa.Table) -> pa.Table:
        grp = table.column("grp")[0].as_py()
        ids = table.column("id").to_numpy()
        keys, owners = [], []
        for at, runs, _, _ in stretches(kind, concatenated(table.column("text"))):
            keys.append(runs.key)
            owners.append(ids[at + runs.doc])
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort([owner, key])
        key, owner = key[order], owner[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        several = owner[begin] != owner[np.append(begin[1:], len(key)) - 1] if len(begin) else np.zeros(0, bool)
        key = key[begin]
        value = short(key) | several.astype(np.uint32)
        rows = [(b, grp, value[at].tobytes()) for b, at in in_buckets(bucket_of(key, buckets), buckets)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "grp": pa.array([r[1] for r in rows], pa.int32()), "anchors": pa.array([r[2] for r in rows], pa.binary())})

    def shared(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x, np.uint32) for x in binary(table.column("anchors"))]
        every = np.concatenate(sent)
        # several bits of one key are of one or two kinds; a key of several groups or documents is shared
        alone, several = every & np.uint32(0xFFFFFFFE), (every & np.uint32(1)) > 0
        values, counts = np.unique(alone, return_counts=True)
        keep = values[(counts > 1) | among(values, np.unique(alone[several]))]
        answers = [a[among(a, keep)] for a in (x & np.uint32(0xFFFFFFFE) for x in sent)]
        return pa.table({"grp": table.column("grp"), "bucket": table.column("bucket"), "anchors": pa.array([a.tobytes() for a in answers], pa.binary())})

    first = texts.groupBy("grp").applyInArrow(anchors, "bucket int, grp int, anchors binary")
    answers = first.groupBy("bucket").applyInArrow(shared, "grp int, bucket int, anchors binary")

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        grp = left.column("grp")[0].as_py()
        order = np.argsort(left.column("id").to_numpy(), kind="stable")
        left = left.take(pa.array(order))
        ids, column = left.column("id").to_numpy(), concatenated(left.column("text"))
        known = [(np.uint64(b) << np.uint64(32)) | np.frombuffer(a, np.uint32).astype(np.uint64) for b, a in zip(right.column("bucket").to_pylist(), binary(right.column("anchors")), strict=True)]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        held: list[tuple[int, Runs, np.ndarray, Callable]] = []
        units = np.zeros(len(ids), np.int64)
        for at, runs, first_unit, cut in stretches(kind, column):
            units[at : at + len(first_unit) - 1] = np.diff(first_unit)
            full = (bucket_of(runs.key, buckets).astype(np.uint64) << np.uint64(32)) | short(runs.key).astype(np.uint64)
            hit = np.flatnonzero(among(full, known))
            held.append((at, runs.at(hit), first_unit, cut))
        del known
        rows = len(ids)
        sent, of_doc, places = contexts_of(held, ids, buckets, kind.width)
        cuts = np.searchsorted(of_doc, np.arange(rows + 1)).tolist()
        packed_runs = [packed([places[:, a:b].tobytes()]) if b > a else None for a, b in zip(cuts, cuts[1:], strict=False)]
        hashes = left.column("t").to_pylist()
        del left, column, held, of_doc, places
        nothing, none = [None] * len(sent), [None] * rows
        out = pa.table(
            {
                "grp": pa.array([grp] * (rows + len(sent)), pa.int32()),
                "id": pa.array([*ids.tolist(), *nothing], pa.int64()),
                "t": pa.array([*hashes, *nothing], pa.int64()),
                "n_units": pa.array([*units.tolist(), *nothing], pa.int64()),
                "count": pa.array([*np.diff(cuts).tolist(), *(x[1] for x in sent)], pa.int32()),
                "runs": pa.array([*packed_runs, *nothing], pa.binary()),
                "bucket": pa.array([*none, *(x[0] for x in sent)], pa.int32()),
                "content": pa.array([*none, *(x[2] for x in sent)], pa.binary()),
                "rest": pa.array([*none, *(x[3] for x in sent)], pa.binary()),
            }
        )
        del sent, packed_runs
        let_go()
        return out

    schema = "grp int, id long, t long, n_units long, count int, runs binary, bucket int, content binary, rest binary"
    both = written(texts.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(contexts, schema), "contexts")

    def decided(table: pa.Table) -> pa.Table:
        let_go()
        bucket = Contexts(zip(table.column("count").to_pylist(), *((x.as_buffer() for x in table.column(c)) for c in ("content", "rest")), strict=True))
        masks = np.split(bucket.masks(kind.resolve), np.cumsum(bucket.counts)[:-1])
        data = pa.array([packed([m.tobytes()]) for m in masks], pa.binary())
        del bucket, masks
        let_go()
        return pa.table({"grp": table.column("grp"), "bucket": table.column("bucket"), "count": table.column("count"), "masks": data})

    sent = both.where("id is null").select("grp", "bucket", "count", "content", "rest")
    # written, so that the shuffle of contexts is let go before texts are shuffled again
    told = written(sent.groupBy("bucket").applyInArrow(decided, "grp int, bucket int, count int, masks binary"), "masks")

    def applied(left: pa.Table, right: pa.Table) -> pa.Table:
        let_go()
        masks, runs = {}, {}
        for i, t, bucket, count, n, data in zip(*(right.column(c).to_pylist() for c in ("id", "t", "bucket", "count", "n_units", "data")), strict=True):
            if bucket is not None:
                masks[bucket] = np.frombuffer(unpacked(data, 8 * count), np.uint64)
            else:
                runs[i, t] = n, (np.frombuffer(unpacked(data, 16 * count), np.int32).reshape(4, count).T if data else None)
        out: dict[str, list] = {k: [] for k in ("n_units", "n_removed", "n_spans", "kept_sha256", "kept")}
        for i, t, text in zip(*(left.column(c).to_pylist() for c in ("id", "t", "text")), strict=True):
            n, own = runs[i, t]
            out["n_units"].append(n)
            removed = None if own is None else removed_units(n, own.tolist(), masks, kind.width)
            kept = kind.finish(text.encode(), removed)
            out["n_removed"].append(0 if removed is None else int(removed.sum()))
            out["n_spans"].append(0 if removed is None else int((np.diff(removed.astype(np.int8), prepend=0) == 1).sum()))
            out["kept_sha256"].append(sha256_hex(kept))
            out["kept"].append(None if removed is None else kept)
        kinds = {"n_units": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary()}
        return pa.table({"id": left.column("id")} | {k: pa.array(v, kinds[k]) for k, v in out.items()})

    none = F.lit(None)
    answered = told.select("grp", none.cast("long").alias("id"), none.cast("long").alias("t"), none.cast("long").alias("n_units"), "count", "bucket", F.col("masks").alias("data"))
    known = both.where("id is not null").select("grp", "id", "t", "n_units", "count", "bucket", F.col("runs").alias("data")).unionByName(answered)
    return texts.groupBy("grp").cogroup(known.groupBy("grp")).applyInArrow(applied, "id long, n_units long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def removed_units(n: int, runs: list[list[int]], masks: dict[int, np.ndarray], width: int) -> np.ndarray:
    """Units of a document that its removed windows cover, from runs (start, windows, bucket, place)."""
    edge = np.zeros(n + 1, np.int32)
    for start, windows, bucket, place in runs:
        mask = (1 << windows) - 1 if place < 0 else int(masks[bucket][place])
        if mask == (1 << windows) - 1:
            edge[start] += 1
            edge[start + windows + width - 1] -= 1
            continue
        while mask:
            low = (mask & -mask).bit_length() - 1
            edge[start + low] += 1
            edge[start + low + width] -= 1
            mask &= mask - 1
    return np.cumsum(edge[:-1]) > 0
