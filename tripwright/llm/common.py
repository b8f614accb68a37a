"""Helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch. Texts can be long, so that the default of 10,000 rows is too many.
BATCH_ROWS = 2_000
BATCH_BYTES = 4 << 20

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Place of a row whose id is null: before all others.
NULL_ID = -(1 << 63)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, which may not have it on their path."""
    context = spark.sparkContext
    if getattr(context, "_tripwright_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tripwright-")) / "tripwright.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._tripwright_shipped = True


def bounded_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once, by rows and by bytes."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def let_go() -> None:
    """Give memory that a Python worker no longer uses back to the system; workers live on between stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where the session names none, as in local tests."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tripwright-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, *sort: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage and keeps the work done.

    The shuffle files behind it are let go as soon as it is written; nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.sortWithinPartitions(*sort) if sort else df).write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(table: DataFrame) -> None:
    """Remove a written table that nothing reads any more."""
    spark = table.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` for small frames; the folder is the session's."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets (null: empty), without a Python object per row."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; null is empty."""
    return [x or "" for x in column.to_pylist()]


def input_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts: one aggregate over the column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("long") + 64), F.lit(0))).first()[0]
