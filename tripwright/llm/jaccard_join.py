"""N-gram Jaccard join with PartEnum signatures, and the components of its links.

A document's set holds its different runs of ``SHINGLE`` words. Sets of sizes l..l/0.9 form a band; two sets that
link lie in one band or in neighbouring ones, so that each set takes part in its own band and the next. In a band
with largest size r, linked sets differ in at most ``k = 2 r (1 - 0.9) / (1 + 0.9)`` shingles. The domain of
shingles is cut into ``k // 2 + 1`` first-level partitions (one more for larger k), so that one of them has at most one
difference. Each is cut into three second-level partitions, and each subset that leaves one of them out is a
signature: the subset without the difference is equal on both sides. For k = 0 the whole set is the signature. Empty
subsets give no signature unless a set has too few partitions whose subsets all hold something; then both sides of a
link that needs one have it.

1. Signatures go to buckets as packed arrays. Before that a task keeps one set, the least, for each signature among
   the rows it holds, and ties the others to it. A bucket ties the sets that came with one signature to the least of
   them: stars, never all pairs. Of the stars that a set lies in, the centres are tied to the least one.
2. The components of the stars are clusters: all links lie inside clusters. A cluster above ``BLOCK_SHINGLES`` is cut
   again: linked sets have one of their rarest fifth (one minus the similarity) of shingles in common, in any order that
   is the same for all, so that stars over those shingles hold all its links too. The order goes by the number of sets
   that hold a shingle, as a power of two, then by hash. Sets are dealt over chunks; a chunk sends each of its different
   shingles once with its count, and hears of the common ones, so that a shingle that all sets hold is a row a chunk.
3. Clusters are checked exactly. A cluster above ``BLOCK_SHINGLES`` is dealt over blocks, and each pair of blocks is
   one task, so that no task holds an unbounded group; usual clusters are one block. A task counts common shingles
   through an inverted index, skips what lies in one component already and gives back a spanning forest. Texts of
   different sets in clusters are shuffled, and their shingles worked out again; no shingle and no signature is stored.
4. The components of the forests, with exact copies joined by set hash and the sets of one id tied to it, give the result.

Defined cases: a null or empty text and a text of white space have no shingles and are linked with nothing; texts with
fewer words are one shingle; rows with one id are one document; a null id is less than all others; empty tables give
empty tables; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.common import NULL_ID, bounded_batches, let_go, partitions, removed, text_bytes, written
from tripwright.llm.components import components
from tripwright.llm.words import mixed, run_hashes, word_hashes, word_places

SHINGLE = 3
PERCENT = 90
#: Shingles of one block of a cluster.
BLOCK_SHINGLES = 1_000_000
#: Signatures that a task holds before it sends them, and that a bucket has on average.
HELD_SIGNATURES = 250_000
BUCKET_SIGNATURES = 300_000
#: Shingles that two to this power of sets hold are common; those of a single set come first and tie it to nothing.
COMMON_POWER = 1
#: Bytes of text that are hashed at once.
STRETCH = 1 << 18


@lru_cache(maxsize=8)
def bands(percent: int, top: int) -> np.ndarray:
    """First sizes of the bands up to a size; the last of a band is the greatest that links with its first."""
    firsts = [1]
    while firsts[-1] <= top:
        firsts.append(firsts[-1] * 100 // percent + 1)
    return np.array(firsts, np.int64)


def signatures(shingles: np.ndarray, percent: int = PERCENT, subsets: bool = True) -> np.ndarray:
    """PartEnum signatures of one set, given as sorted different hashes."""
    n = len(shingles)
    firsts = bands(percent, 1 << max(10, n.bit_length() + 1))
    own = int(np.searchsorted(firsts, n, side="right")) - 1
    spread = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)
    out = []
    for band in (own, own + 1):
        top = int(firsts[band + 1]) - 1
        k = 2 * top * (100 - percent) // (100 + percent)
        # of so many first-level partitions one has at most one difference (without subsets: none)
        each = 2 if subsets and k else 1
        needed = k // each + 1
        groups, size = needed + (k >= 8), 3 if each == 2 else 1
        part = ((spread * np.uint64(groups * size)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sums, filled = np.zeros(groups * size, np.uint64), np.unique(part)
        sums[filled] = np.add.reduceat(mixed(shingles + np.uint64(band + 1))[order], np.flatnonzero(np.diff(part[order], prepend=-1)))
        has = np.zeros(groups * size, np.int64)
        has[filled] = 1
        sums, has = sums.reshape(groups, size), has.reshape(groups, size)
        if size > 1:
            # each subset leaves out one second-level partition
            sums, has = sums.sum(1, dtype=np.uint64, keepdims=True) - sums, has.sum(1, keepdims=True) - has
        # empty ones count only where there are too few partitions whose subsets all hold something
        chosen = np.flatnonzero(has.ravel()) if (has > 0).all(1).sum() >= needed else np.arange(groups * size)
        out.append(mixed(sums.ravel()[chosen] ^ mixed(chosen.astype(np.uint64) * np.uint64(2_654_435_761) + np.uint64(band << 40))))
    return np.concatenate(out)


def sets_of(column: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text, worked out over a bounded stretch of texts at a time."""
    data, offsets = text_bytes(column)
    out: list[np.ndarray] = []
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STRETCH, "right")) - 1)
        out += sets_of_stretch(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], shingle)
        at = to
    return out


def sets_of_stretch(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    starts, ends, first = word_places(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    runs = run_hashes(words, shingle)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(runs[a : b - shingle + 1]))
        else:
            out.append(run_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def set_hashes(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    one, two = mixed(shingles).sum(dtype=np.uint64), mixed(shingles + np.uint64(12_345)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def described(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, n, h1, h2, t) of each row; ``t`` is a hash of its text."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = sets_of(batch.column(1), shingle)
            hashes = [set_hashes(s) for s in sets]
            columns = [[len(s) for s in sets], [h[0] for h in hashes], [h[1] for h in hashes]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns), batch.column(2)], ["id", "n", "h1", "h2", "t"])
        let_go()

    return told_apart(docs, id_col, text_col).mapInArrow(describe, "id long, n long, h1 long, h2 long, t long")


def least_of_equal(sigs: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, least set of each, stars): different signatures, and (2, n) ties of their other sets to the least."""
    order = np.lexsort([sets, sigs])
    sigs, sets = sigs[order], sets[order]
    new = np.ones(len(sigs), bool)
    new[1:] = sigs[1:] != sigs[:-1]
    least = sets[np.flatnonzero(new)][np.cumsum(new) - 1]
    other = least != sets
    stars = np.stack([least[other], sets[other]])
    return sigs[new], sets[new], np.unique(stars, axis=1) if stars.size else stars


PACKED = "bucket int, sigs binary, sets binary"


def packed(sigs: np.ndarray, sets: np.ndarray, buckets: int) -> pa.Table:
    """Rows (bucket, sigs, sets) of a task's part, with one set for each signature; bucket -1 has stars."""
    sigs, least, stars = least_of_equal(sigs, sets)
    rows = [(-1, stars[0].tobytes(), stars[1].tobytes())] if stars.size else []
    # signatures ascend, and so do their buckets; the bits that chose the bucket need not be sent
    cuts = np.searchsorted(bucket_of(sigs, buckets), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        some = slice(cuts[b], cuts[b + 1])
        rows.append((b, low_bytes(sigs[some]), least[some].tobytes()))
    return table_of(rows, {"bucket": pa.int32(), "sigs": pa.binary(), "sets": pa.binary()})


def table_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def packed_signatures(docs: DataFrame, text_col: str, shingle: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, sigs, sets) as packed arrays, one set for each signature of a task's part; bucket -1 has stars."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        count = 0
        for batch in batches:
            for s in sets_of(batch.column(0), shingle):
                if len(s):
                    held.append(signatures(s, percent))
                    owners.append(np.full(len(held[-1]), set_hashes(s)[0]))
                    count += len(held[-1])
                    if count >= HELD_SIGNATURES:
                        yield from packed(np.concatenate(held), np.concatenate(owners), buckets).to_batches()
                        held, owners, count = [], [], 0
                        let_go()
        if held:
            yield from packed(np.concatenate(held), np.concatenate(owners), buckets).to_batches()
        held, owners = [], []
        let_go()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(pack, PACKED)


def bucket_of(sigs: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the upper 32 bits."""
    return (((sigs >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def low_bytes(sigs: np.ndarray) -> bytes:
    """The lower six bytes of each signature: few of one bucket agree in them by chance, and the exact check parts those."""
    return sigs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def read_low_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def stars_of(packed: DataFrame) -> DataFrame:
    """(a, b): sets of one signature tied to the least of them, as ties with the least centre of each set."""

    def tie(table: pa.Table) -> pa.Table:
        sigs, sets = table.column("sigs").to_pylist(), [np.frombuffer(x, np.int64) for x in table.column("sets").to_pylist()]
        _, _, stars = least_of_equal(np.concatenate([read_low_bytes(x) for x in sigs]), np.concatenate(sets))
        let_go()
        return pa.table({"a": pa.array(stars[0]), "b": pa.array(stars[1])})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, np.int64)) for x in (a, b)], ["a", "b"])

    between = packed.where("bucket >= 0").groupBy("bucket").applyInArrow(tie, "a long, b long")
    inside = packed.where("bucket < 0").select("sigs", "sets").mapInArrow(unpack, "a long, b long")
    return between.unionByName(inside).distinct()


def contracted(stars: DataFrame) -> DataFrame:
    """Stars with fewer ties: each set to the least of its centres, and its other centres to that one."""
    low = F.min("a").over(Window.partitionBy("b"))
    own = stars.withColumn("low", low)
    ties = own.select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    return ties.where("a <> b").distinct()


def chunk_counts(chunks: DataFrame, shingle: int, buckets: int) -> DataFrame:
    """(bucket, chunk, keys, counts): different shingles of each chunk, packed, with the number of its sets that hold them."""
    kinds = {"bucket": pa.int32(), "chunk": pa.int64(), "keys": pa.binary(), "counts": pa.binary()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None

        def sent() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(mixed(np.concatenate(held)), return_counts=True)
            cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
            some = [slice(cuts[b], cuts[b + 1]) for b in range(buckets)]
            rows = [(b, last, keys[x].tobytes(), counts[x].astype(np.int32).tobytes()) for b, x in enumerate(some) if x.stop > x.start]
            yield from table_of(rows, kinds).to_batches()

        for batch in batches:
            for chunk, s in zip(batch.column(0).to_pylist(), sets_of(batch.column(1), shingle), strict=True):
                if chunk != last and held:
                    yield from sent()
                    held = []
                held.append(s)
                last = chunk
        if held:
            yield from sent()

    return chunks.select("chunk", "text").mapInArrow(count, "bucket int, chunk long, keys binary, counts binary")


def common_shingles(counted: DataFrame) -> DataFrame:
    """(chunk, keys, powers): the common shingles of each chunk and the power of two of the sets, of all chunks, that hold them."""
    kinds = {"chunk": pa.int64(), "keys": pa.binary(), "powers": pa.binary()}

    def number(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.int32) for x in table.column("counts").to_pylist()])
        values, places = np.unique(np.concatenate(keys), return_inverse=True)
        powers = np.log2(np.bincount(places, weights=counts, minlength=len(values))).astype(np.uint8)[places]
        rows, at = [], 0
        for chunk, own in zip(table.column("chunk").to_pylist(), keys, strict=True):
            power = powers[at : at + len(own)]
            at += len(own)
            if (some := power >= COMMON_POWER).any():
                rows.append((chunk, own[some].tobytes(), power[some].tobytes()))
        return table_of(rows, kinds)

    return counted.groupBy("bucket").applyInArrow(number, "chunk long, keys binary, powers binary")


def rarest(keys: np.ndarray, powers: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Places of the rarest shingles of each set (sets one after another): as many as a linked set may lack, and one."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort([keys, powers, owner])
    place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lacking = sizes - -(-sizes * percent // 100)
    return order[place <= lacking[owner]]


def rare_signatures(chunks: DataFrame, common: DataFrame, shingle: int, percent: int, buckets: int) -> DataFrame:
    """Packed signatures, as of ``packed_signatures``: one for each of the rarest shingles of a set, in its cluster."""

    def pack(texts: pa.Table, heard: pa.Table) -> pa.Table:
        sets = sets_of(texts.column("text").combine_chunks(), shingle)
        sizes = np.array([len(s) for s in sets], np.int64)
        owners, clusters = (np.repeat(np.array(texts.column(c).to_pylist(), np.int64), sizes) for c in ("h1", "cluster"))
        if not len(owners):
            return table_of([], {"bucket": pa.int32(), "sigs": pa.binary(), "sets": pa.binary()})
        keys = mixed(np.concatenate(sets))
        powers = np.zeros(len(keys), np.uint8)
        if heard.num_rows:
            known = np.concatenate([np.frombuffer(x, np.uint64) for x in heard.column("keys").to_pylist()])
            order = np.argsort(known)
            known, power = known[order], np.concatenate([np.frombuffer(x, np.uint8) for x in heard.column("powers").to_pylist()])[order]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            powers = np.where(known[at] == keys, power[at], 0)
        chosen = rarest(keys, powers, sizes, percent)
        return packed(mixed(keys[chosen] ^ mixed(clusters[chosen].astype(np.uint64))), owners[chosen], buckets)

    return chunks.groupBy("chunk").cogroup(common.groupBy("chunk")).applyInArrow(pack, PACKED)


def cut_again(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, block: int) -> DataFrame:
    """The same members with clusters above a block cut by rare shingles; what is alone then goes."""
    large = members.groupBy("cluster").agg(F.sum("n").alias("total")).where(F.col("total") > block)
    inside = members.join(large.select("cluster"), "cluster", "left_semi")
    total = inside.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return members
    chunk = F.pmod(F.xxhash64("h1", "h2"), F.lit(total * 2 // block + 1)).alias("chunk")
    texts = told_apart(docs, id_col, text_col).dropDuplicates(["id", "t"]).join(inside, ["id", "t"])
    dealt = texts.select(chunk, "h1", "cluster", "text").repartition(partitions(docs.sparkSession), "chunk")
    chunks = written(dealt, "chunks", "chunk")
    common = written(common_shingles(chunk_counts(chunks, shingle, total // BUCKET_SIGNATURES + 1)), "common")
    buckets = total * (100 - percent) // (100 * BUCKET_SIGNATURES) + 1
    stars = written(stars_of(rare_signatures(chunks, common, shingle, percent, buckets)), "stars")
    for table in (chunks, common):
        removed(table)
    labels = components(contracted(stars)).select(F.col("node").alias("h1"), F.col("label").alias("cluster"))
    removed(stars)
    return members.join(large.select("cluster"), "cluster", "left_anti").unionByName(inside.drop("cluster").join(labels, "h1"))


def told_apart(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, t): rows with one id are told apart by a hash of the text."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("text"))
    return rows.withColumn("t", F.xxhash64("text"))


def forest(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets, exactly."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    parent = np.arange(m)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges: list[tuple[int, int]] = []
    owner = np.repeat(np.arange(m), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    values, postings = flat[order], owner[order]
    begin, end = np.searchsorted(values, flat, "left"), np.searchsorted(values, flat, "right")
    at = np.concatenate([[0], np.cumsum(sizes)])

    def link(x: int) -> None:
        """Join a set with all that link with it."""
        a, b = begin[at[x] : at[x + 1]], end[at[x] : at[x + 1]]
        shared = (b - a) > 1
        a, b = a[shared], b[shared]
        if not len(a):
            return
        widths = b - a
        picked = np.repeat(a - np.concatenate([[0], np.cumsum(widths)[:-1]]), widths) + np.arange(int(widths.sum()))
        common = np.bincount(postings[picked], minlength=m)
        linked = np.flatnonzero(100 * common >= percent * (sizes + sizes[x] - common))
        for y in linked.tolist():
            if (p := root(x)) != (q := root(y)):
                parent[max(p, q)] = min(p, q)
                edges.append((int(ids[x]), int(ids[y])))

    # one large component forms round a few sets; after that only sets outside it can add links
    seen = np.zeros(m, bool)
    for x in dict.fromkeys(np.linspace(0, m - 1, min(m, 16)).astype(int).tolist()):
        link(x)
        seen[x] = True
    roots = np.array([root(x) for x in range(m)])
    largest = np.bincount(roots).argmax()
    for x in np.flatnonzero(~seen & (roots != largest)).tolist():
        link(x)
    return edges


def links_in_clusters(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, block: int) -> DataFrame:
    """(a, b) spanning forests over the clusters of (id, t, h1, h2, n, cluster), as links between ids.

    An id may have several sets: a set is read from the row with its id and the hash of its text, and kept by its own hash.
    """
    spark = docs.sparkSession
    total = members.groupBy("cluster").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    blocks = F.ceil(F.col("total") / F.lit(block)).cast("int")
    placed = members.join(total, "cluster").select("id", "t", "h1", "h2", "cluster", blocks.alias("blocks"))
    texts = told_apart(docs, id_col, text_col).dropDuplicates(["id", "t"])
    chosen = texts.join(placed, ["id", "t"])
    own = F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = chosen.withColumn("own", own).withColumn("other", other).select(
        "id", "h1", "h2", "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "text"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        last = None

        def done() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                edges = forest(np.array([x for x, _ in held.values()]), [s for _, s in held.values()], percent)
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            ids, h1, h2, clusters, i, j = (batch.column(c).to_pylist() for c in range(6))
            sets = sets_of(batch.column(6), shingle)
            for k, own in enumerate(zip(h1, h2, strict=True)):
                # texts of one id and hash that differ have other sets
                if set_hashes(sets[k]) != own:
                    continue
                key = (clusters[k], i[k], j[k])
                if key != last:
                    yield from done()
                    held, last = {}, key
                held[own] = (ids[k], sets[k])
        yield from done()

    keys = ["cluster", "i", "j"]
    return dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(link, "a long, b long")


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row; see the module's text."""
    bounded_batches(docs.sparkSession)
    base = written(described(docs, id_col, text_col, shingle), "sets")
    total = base.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = total * (100 - percent) // (25 * BUCKET_SIGNATURES) + 1
    stars = written(stars_of(packed_signatures(docs, text_col, shingle, percent, buckets)), "stars")
    clusters = components(contracted(stars))
    rows = base.select("id", "n", "h1", "h2")
    least = base.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct("id", "t")).alias("least"), F.max("n").alias("n"))
    copies = least.select("h1", "h2", "least.id", "least.t", "n")
    members = copies.join(clusters.select(F.col("node").alias("h1"), F.col("label").alias("cluster")), "h1")
    members = cut_again(docs, written(members, "members"), id_col, text_col, shingle, percent, block)
    links = written(links_in_clusters(docs, members, id_col, text_col, shingle, percent, block), "links")
    linked = components(links.unionByName(ties(rows, copies)))
    first = copies.join(linked.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("label", "id").alias("first")
    )
    full = rows.where("n > 0").join(first, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left").select("id", "n", "first")
    # a row without shingles goes with the other rows of its id
    empty = rows.where("n = 0").join(linked.withColumnRenamed("node", "id"), "id", "left").select("id", "n", F.col("label").alias("first"))
    out = full.unionByName(empty)
    kind = docs.schema[id_col].dataType
    known = F.when(F.col("id") != NULL_ID, F.col("id")).cast(kind)
    component = F.coalesce("first", "id")
    return out.select(known.alias(id_col), F.col("n").alias("n_shingles"), F.when(component != NULL_ID, component).cast(kind).alias("component_id"))


def ties(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """(a, b): each id with several sets tied to the least id of each of them; ids with one set need none."""
    lows, highs = (F.min(F.struct("h1", "h2")), F.max(F.struct("h1", "h2")))
    several = rows.groupBy("id").agg(lows.alias("low"), highs.alias("high")).where("low <> high").select("id")
    held = rows.where("n > 0").join(several, "id", "left_semi").select(F.col("id").alias("b"), "h1", "h2").distinct()
    return held.join(copies.select("h1", "h2", F.col("id").alias("a")), ["h1", "h2"]).where("a <> b").select("a", "b")
