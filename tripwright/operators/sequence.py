"""Window computations over tracks of any length.

A window over ``partitionBy(track)`` sorts a whole track in one task. That is right for
ordinary trips. A track above the row limit is cut into blocks of consecutive rows; every
block also carries the rows beside it, as many as the computation looks back and ahead, so
each row sees exactly the neighbours it has in the whole track.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripwright.operators.skew import (
    ROWS_PER_TASK,
    HeavyKeys,
    broadcast_if_small,
    checkpointed,
    ensure_checkpoint_folder,
    heavy_keys,
)


def over_tracks(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    reach: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
    ahead: int = 1,
) -> DataFrame:
    """Apply ``compute(frame, window)`` to each track.

    ``reach`` is the number of rows the computation looks back, ``ahead`` the number it looks ahead.
    ``order`` must order the rows of a track without ties. ``compute`` must keep the columns
    of its input and must not drop rows. Rows without key belong to no track and are left out.

    ``heavy`` are the tracks to cut, if the caller knows them from a cheaper count than one over
    ``rows``; more tracks than needed do no harm.
    """
    keys = list(keys)
    ensure_checkpoint_folder(rows.sparkSession)
    rows = rows.dropna(subset=keys)
    if heavy is None:
        heavy = heavy_keys(rows, keys, limit)
    if heavy.size == 0:
        return compute(rows, Window.partitionBy(*keys).orderBy(*order))

    marks = heavy.for_join().drop("_rows")
    parts = heavy.rows // limit + 2  # as many ranges as there are blocks
    cut = rows.join(marks, keys, "left_semi")
    blocks = _blocks(cut, keys, order, reach, ahead, limit, parts)
    plain = (
        rows.join(marks, keys, "left_anti")
        .withColumn("_block", F.lit(0).cast("bigint"))
        .withColumn("_context", F.lit(False))
    )
    block_keys = [*keys, "_block"]
    together = plain.unionByName(blocks).repartition(*[F.col(k) for k in block_keys])
    done = compute(together, Window.partitionBy(*block_keys).orderBy(*order))
    return done.where(~F.col("_context")).drop("_block", "_context")


def with_pieces(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    piece_rows: int,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``piece``: the place of a row among those of its key, in order, div ``piece_rows``.

    The rule is the same for all sizes, so pieces always hold consecutive rows. ``order`` must
    order the rows of a key without ties. Rows without key are left out.
    """
    keys = list(keys)
    ensure_checkpoint_folder(rows.sparkSession)
    rows = rows.dropna(subset=keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    heavy = heavy_keys(rows, keys, limit)
    if heavy.size == 0:
        placed = rows.withColumn("_place", place.cast("bigint"))
    else:
        marks = heavy.for_join().drop("_rows")
        light = rows.join(marks, keys, "left_anti").withColumn("_place", place.cast("bigint"))
        parts = heavy.rows // limit + 2
        split = _placed(rows.join(marks, keys, "left_semi"), keys, order, parts)
        whole = (F.col("_start") + F.col("_place") - 1).cast("bigint")
        split = split.withColumn("_place", whole).select(*light.columns)
        placed = light.unionByName(split)
    piece = F.call_function("div", F.col("_place"), F.lit(piece_rows)).cast("bigint")
    return placed.withColumn("piece", piece).drop("_place")


def _placed(
    rows: DataFrame, keys: list[str], order: Sequence[Column], parts: int
) -> DataFrame:
    """Rows with ``_place``, from 1, in a range of their track and the rows before it, ``_start``."""
    # The range partitions are even even if one key holds everything, because the order columns
    # take part in the ranges. Their ids are checkpointed, so counts and rows agree afterwards.
    ranged = rows.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    part_keys = [*keys, "_part"]
    local = checkpointed(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_place", F.row_number().over(Window.partitionBy(*part_keys).orderBy(*order))
        )
    )
    # One row per track and range partition.
    sizes = local.groupBy(*part_keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *part_keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return local.join(broadcast_if_small(starts, starts.count()), part_keys)


def _blocks(
    rows: DataFrame,
    keys: list[str],
    order: Sequence[Column],
    reach: int,
    ahead: int,
    limit: int,
    parts: int,
) -> DataFrame:
    placed = _placed(rows, keys, order, parts)
    length = max(limit, reach + 1, ahead + 1)
    place = F.col("_start") + F.col("_place") - 1
    block = F.call_function("div", place, F.lit(length)).cast("bigint")
    # A block also needs the rows after its end that the computation looks ahead to.
    offset = F.pmod(place, F.lit(length))
    homes = F.filter(
        F.array(
            F.struct(block.alias("_block"), F.lit(False).alias("_context")),
            F.when(
                offset >= length - reach,
                F.struct((block + 1).alias("_block"), F.lit(True).alias("_context")),
            ),
            F.when(
                (offset < ahead) & (block > 0),
                F.struct((block - 1).alias("_block"), F.lit(True).alias("_context")),
            ),
        ),
        lambda h: h.isNotNull(),
    )
    return (
        placed.withColumn("_home", F.explode(homes))
        .select("*", "_home._block", "_home._context")
        .drop("_home", "_part", "_place", "_start")
    )
