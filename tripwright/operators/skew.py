"""Finding and spreading heavy keys.

A shuffle sends all rows of a key to one task. Where a single trip, vehicle or map cell may
hold a large part of the data, the operators first count rows per key (combined on the map
side, so the count itself is not skewed) and treat the keys above a limit separately.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that a single task may hold.
ROWS_PER_TASK = 2_000_000
# Largest frame that is broadcast on purpose, and what a value of no fixed width is taken for.
BROADCAST_BYTES = 32 << 20
WIDE_VALUE_BYTES = 256


@dataclass(frozen=True)
class HeavyKeys:
    """Keys above the row limit, with the rows of each (column ``_rows``) and of all of them."""

    frame: DataFrame
    size: int
    rows: int

    def for_join(self) -> DataFrame:
        return broadcast_if_small(self.frame, self.size)


def row_bytes(frame: DataFrame) -> int:
    """Bytes of a row: 8 for numbers, dates and flags, ``WIDE_VALUE_BYTES`` for anything else."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return sum(8 if isinstance(f.dataType, fixed) else WIDE_VALUE_BYTES for f in frame.schema)


def broadcast_if_small(frame: DataFrame, size: int) -> DataFrame:
    """Broadcast a frame of known row count and few bytes; a larger one is left to a shuffle."""
    return F.broadcast(frame) if size * row_bytes(frame) <= BROADCAST_BYTES else frame


def heavy_keys(
    frame: DataFrame,
    keys: Sequence[str],
    limit: int = ROWS_PER_TASK,
    weight: Column | None = None,
) -> HeavyKeys:
    """Keys with more than ``limit`` rows; rows without key join nothing and do not count.

    ``weight`` is the number of rows that a row will become, if not one.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (
        frame.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(rows.alias("_rows"))
        .where(F.col("_rows") > limit)
    )
    size, rows = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    return HeavyKeys(counts, size, rows)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner equi join that splits the heavy keys of its ``big`` side."""
    left, right, joined_on = salted_pair(big, small, keys, spread, limit)
    return left.join(right, joined_on).drop(*[k for k in joined_on if k not in keys])


def salted_pair(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    limit: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Prepare an inner equi join whose ``big`` side may have heavy keys.

    Rows of a heavy key on the big side get a salt from the ``spread`` columns, which must tell
    the rows of a key apart; the small side is repeated once per salt. Other keys keep salt 0.
    Returns both frames and the join keys.
    """
    heavy = heavy_keys(big, keys, limit)
    if heavy.size == 0:
        return big, small, list(keys)
    salts = heavy.frame.select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_salts"))
    salts = broadcast_if_small(salts, heavy.size)
    salted = (
        big.join(salts, list(keys), "left")
        .withColumn(
            "_salt",
            F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_salts")), F.lit(0)).cast("int"),
        )
        .drop("_salts")
    )
    repeated = (
        small.join(salts, list(keys), "left")
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
        )
        .drop("_salts")
    )
    return salted, repeated, [*keys, "_salt"]


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tripwright-checkpoint-")


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    """Ask for the folder whatever the size of the data, so that growth alone never fails a query."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))


def checkpointed(frame: DataFrame) -> DataFrame:
    """Write the frame to reliable storage and go on from there."""
    ensure_checkpoint_folder(frame.sparkSession)
    return frame.checkpoint()
