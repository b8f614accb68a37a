"""Shards of near equal bytes by a k-d tree over metadata, in DataFrame operations only.

The tree starts with all documents and the wanted number of shards. A node for several shards is cut at the weighted
quantile that gives each side its part of the shards (the median, if their number is even), along the dimension that
is widest in the node, measured against its width in the whole table; leaves are single shards, near the target bytes.

A cut is found by a distributed search that all nodes of a level share: an aggregate counts the bytes of each node by
``2 ** BUCKET_BITS`` buckets of the dimension, the bucket that holds the quantile is searched in turn, until it is one
row or below the tolerance. Rows with an equal value are told apart by id, then by the checksum of the text, then by a
row number, so that a value, an id or a text that a third of all rows have is cut like any other. Only counts of at
most nodes x buckets come to the driver; rows stay in a table of numbers in the shared folder and learn their node from
a broadcast table of cuts, a row for each node. Texts are read once and not shuffled.

Slots are ranks in a shard by a hash of id and checksum: the numbers are ordered by range, counted for each range, and
numbered inside it, so that no task holds a whole shard.

Defined cases: a null text has no bytes and checksum 0, an empty one likewise; null metadata counts as -1; a null id is
less than all others; repeated rows are rows of their own; an empty table gives an empty table; with fewer rows than
shards some shards are empty; a text larger than a shard's part makes its shard too large, and the others share what
is left of their node. Equal texts need not meet in a shard. Carried columns travel as one struct, so that no name
of theirs can clash.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.llm.common import NULL_ID, partitions, written

SHARDS = 40
#: Bytes that a document takes beside its text.
ROW_BYTES = 16
BUCKET_BITS = 12
#: A bucket below this part of a shard's bytes is not searched further.
TOLERANCE = 0.001
#: Metadata that makes the dimensions beside the size, where a table has it.
METADATA = ("lang", "source", "n_chars")


def coordinate(docs: DataFrame, name: str) -> Column:
    """A metadata column as a whole number: numbers are cut to their integer part, other values give a checksum."""
    kind, col = docs.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return F.coalesce(col.try_cast("long"), F.lit(-1))
    return F.coalesce(F.crc32(col.cast("string").cast("binary")), F.lit(-1))


def described(docs: DataFrame, id_col: str, text_col: str, metadata: tuple[str, ...], carry: list[str]) -> DataFrame:
    """(row, id, size, crc, keys) of each row; ``keys`` holds size, metadata, id, checksum and row number."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("crc"),
        F.array(*(coordinate(docs, c) for c in metadata), F.lit(0).cast("long")).alias("meta"),
        F.monotonically_increasing_id().alias("place"),
    )
    meta = [F.get("meta", F.lit(k)) for k in range(len(metadata))]
    return rows.select("row", "id", "size", "crc", F.array("size", *meta, "id", "crc", "place").alias("keys"))


@dataclass
class Node:
    """Shards ``first`` to ``first + count - 1``, and the search for the cut between its sides."""

    first: int
    count: int
    total: int = 0
    #: places in ``keys`` that order the rows: the widest dimension, id, checksum, row number
    order: list[int] = field(default_factory=list)
    fixed: list[int] = field(default_factory=list)
    low: int = 0
    high: int = -1
    before: int = 0
    cut: list[int] | None = None

    @property
    def left(self) -> int:
        return self.count // 2

    @property
    def shift(self) -> int:
        return max(0, (self.high - self.low).bit_length() - BUCKET_BITS)

    def narrow(self, buckets: list[tuple], enough: float) -> None:
        """Take the bucket that holds the quantile, given (bytes, rows, least and greatest value, the same of the next key)."""
        goal = self.total * self.left
        for nbytes, rows, low, high, next_low, next_high in buckets:
            if (self.before + nbytes) * self.count < goal:
                self.before += nbytes
                continue
            last = len(self.fixed) == len(self.order) - 1
            if rows == 1 or nbytes <= enough or (low == high and last):
                over = (self.before + nbytes) * self.count - goal
                with_it = over < goal - self.before * self.count
                self.cut = [*self.fixed, high + 1 if with_it else low]
            elif low == high:
                self.fixed.append(low)
                self.low, self.high = next_low, next_high
            else:
                self.low, self.high = low, high
            return
        self.cut = []


def key_at(place: str) -> Column:
    return F.get("keys", F.col(place).cast("int"))


LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


def literal(value: int | bool | list) -> str:
    """SQL text of a value; the least long has no literal of its own."""
    if isinstance(value, list):
        return f"array({', '.join(map(literal, value))})" if value else "cast(array() AS array<bigint>)"
    if isinstance(value, bool):
        return str(value)
    return f"{value}L" if value > LEAST else f"({LEAST + 1}L - 1L)"


def beside(rows: DataFrame, names: str, table: list[tuple]) -> DataFrame:
    """Rows with what is known of their node; the table has a row for each node, which are fewer than the shards twice."""
    values = ", ".join(f"({', '.join(map(literal, r))})" for r in table)
    return rows.join(F.broadcast(rows.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(node, {names})")), "node")


def cut_row(node: Node) -> tuple[list[int], list[int], bool]:
    """The cut of a node as (places in ``keys``, values, all rows are left of it)."""
    cut = node.cut or []
    everything = not cut or cut[-1] > GREATEST
    return node.order or [0] * 4, [LEAST] * 4 if everything else [*cut, *[LEAST] * (4 - len(cut))], everything


def descended(rows: DataFrame, nodes: list[Node], sides: list[tuple[int, int]]) -> DataFrame:
    """Rows with their node on the next level, by the cut of their node and the nodes on its sides."""
    table = [(k, *cut_row(n), *sides[k]) for k, n in enumerate(nodes)]
    placed = beside(rows, "_places, _cut, _all, _left, _right", table)
    before = F.lit(False)
    for d in reversed(range(4)):
        own, edge = F.get("keys", F.get("_places", F.lit(d)).cast("int")), F.get("_cut", F.lit(d))
        before = (own < edge) | ((own == edge) & before)
    return placed.withColumn("node", F.when(F.col("_all") | before, F.col("_left")).otherwise(F.col("_right"))).drop("_places", "_cut", "_all", "_left", "_right")


def search(rows: DataFrame, nodes: list[Node], enough: float) -> None:
    """Find the cuts of all nodes of a level; each round is one aggregate over the rows still between bounds."""
    while any(n.cut is None for n in nodes):
        table = []
        for k, n in enumerate(nodes):
            if n.cut is None:
                at = len(n.fixed)
                after = n.order[min(at + 1, len(n.order) - 1)]
                table.append((k, n.order, n.fixed, n.order[at], after, n.low, n.high, n.shift))
        placed = beside(rows, "_order, _fixed, _own, _after, _low, _high, _shift", table)
        same = F.lit(True)
        for d in range(max(len(r[2]) for r in table)):
            value = F.get("_fixed", F.lit(d))
            same = same & (value.isNull() | (F.get("keys", F.get("_order", F.lit(d)).cast("int")) == value))
        found = (
            placed.where(same & key_at("_own").between(F.col("_low"), F.col("_high")))
            .select("node", "size", key_at("_own").alias("own"), key_at("_after").alias("after"), "_shift")
            .groupBy("node", F.expr("shiftright(own, cast(_shift AS int))").alias("bucket"))
            .agg(F.sum("size"), F.count(F.lit(1)), F.min("own"), F.max("own"), F.min("after"), F.max("after"))
            .collect()
        )
        buckets = defaultdict(list)
        for row in sorted(tuple(r) for r in found):
            buckets[row[0]].append(row[2:])
        for k, n in enumerate(nodes):
            if n.cut is None:
                n.narrow(buckets[k], enough)


def widest(spans: list[tuple[int, int]], whole: list[tuple[int, int]]) -> int:
    """The dimension whose span is the largest part of its span in the whole table; the first of equal ones."""
    parts = [(high - low) / max(1, top - bottom) for (low, high), (bottom, top) in zip(spans, whole, strict=True)]
    return parts.index(max(parts))


def leaves(rows: DataFrame, shards: int, dims: int, tolerance: float) -> DataFrame:
    """``rows`` with the leaf of each as ``shard``; the tree is grown level by level."""
    nodes, whole, enough = [Node(0, shards)], None, 0.0
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    while any(n.count > 1 for n in nodes):
        spans = [f(F.get("keys", F.lit(d))) for d in range(dims) for f in (F.min, F.max)]
        seen = {r[0]: r[1:] for r in rows.groupBy("node").agg(F.sum("size"), *spans).collect()}
        for k, n in enumerate(nodes):
            if n.count == 1 or k not in seen:
                n.cut = []
                continue
            bounds = [tuple(seen[k][1 + 2 * d : 3 + 2 * d]) for d in range(dims)]
            if whole is None:
                whole, enough = bounds, tolerance * seen[k][0] / shards
            dim = widest(bounds, whole)
            n.total, n.order = seen[k][0], [dim, dims, dims + 1, dims + 2]
            n.low, n.high = bounds[dim]
        search(rows, nodes, enough)
        below, sides = [], []
        for n in nodes:
            first = len(below)
            below.append(Node(n.first, n.left or 1))
            if n.count > 1:
                below.append(Node(n.first + n.left, n.count - n.left))
            sides.append((first, len(below) - 1))
        rows, nodes = descended(rows, nodes, sides), below
    return beside(rows, "shard", [(k, n.first) for k, n in enumerate(nodes)]).withColumn("shard", F.col("shard").cast("int")).drop("node")


def with_slots(rows: DataFrame) -> DataFrame:
    """A gapless number from 0 inside each shard, in order of a hash; ranges of rows are counted, then numbered."""
    spark = rows.sparkSession
    order = [F.col("shard"), F.col("hash"), F.col("id"), F.col("crc"), F.element_at("keys", -1)]
    mixed = rows.withColumn("hash", F.xxhash64("id", "crc"))
    ranged = mixed.repartitionByRange(partitions(spark), *order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "kd-ranges")
    counts = ranged.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "range").orderBy(*order[1:])
    ranked = ranged.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["shard", "range"]).withColumn("slot", (F.col("start") + F.col("rank")).cast("long"))


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, target_bytes: int | None = None,
    metadata: tuple[str, ...] = METADATA, carry: list[str] | None = None, tolerance: float = TOLERANCE,
) -> DataFrame:
    """(row, id, size, crc, shard, slot) of each row; ``row`` holds the carried columns, all of them unless named.

    With ``target_bytes`` the number of shards follows from the table.
    """
    known = tuple(c for c in metadata if c in docs.columns)
    rows = written(described(docs, id_col, text_col, known, docs.columns if carry is None else carry), "kd-rows")
    if target_bytes is not None:
        shards = max(1, -(-rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // target_bytes))
    return with_slots(leaves(rows, shards, 1 + len(known), tolerance)).select("row", "id", "size", "crc", "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options: object) -> None:
    """Whole rows as Parquet files in a folder for each shard, with their slots."""
    out = shard_documents(docs, **options)
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    out.select(*columns, "slot", "shard").repartition("shard", F.floor(F.col("slot") / 100_000)).write.partitionBy("shard").parquet(path)


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, **options: object) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row."""
    out = shard_documents(docs, id_col, text_col, shards, carry=[id_col], **options)
    return out.select(
        F.col("row").getField(id_col).alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
