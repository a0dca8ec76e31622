"""Helpers shared by the training-data operators: shared tables, code shipping, text columns in Arrow batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers that were not started from the repository.

    The package is zipped once per application and added with ``addPyFile``; the zip travels through Spark's
    own file server, so no folder has to be shared.
    """
    sc = spark.sparkContext
    done = sc.getLocalProperty("vigil.shipped")
    if done != sc.applicationId:
        target = os.path.join(tempfile.mkdtemp(prefix="vigil-ship-"), "vigil_package.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(PACKAGE):
                for n in names:
                    if n.endswith(".py"):
                        path = os.path.join(folder, n)
                        z.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
        sc.addPyFile(target)
        sc.setLocalProperty("vigil.shipped", sc.applicationId)
    # Texts are long: batches of the default row count would take too much of a worker's memory.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def lean() -> None:
    """In a worker: have large freed arrays go back to the system at once. A worker serves many tasks, and by default its
    allocators keep what the largest of them needed."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD: larger arrays are mapped by themselves
        libc.mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD: blocks of the others are used again
        libc.malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it has its own ways
        pass


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_mod(col: str, mod: int):
    """crc32 of the id's decimal text, modulo ``mod``; a null id gives null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(mod)


def raw(array: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each value of a string or binary array; null gives the empty string."""
    if isinstance(array, pa.ChunkedArray):
        for chunk in array.chunks:
            yield from raw(chunk)
        return
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    n = len(array)
    if n == 0:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset:array.offset + n + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    nulls = array.is_null().to_pylist() if array.null_count else None
    for i in range(n):
        yield b"" if nulls and nulls[i] else bytes(view[at[i]:at[i + 1]])


def hash_sample(df: DataFrame, n: int, *cols: str, seed: int = 7) -> DataFrame:
    """About the ``n`` rows with the smallest hash of ``cols``: ``n``, or somewhat fewer of many equal rows.

    Rows are counted first and those with a larger hash left out before the top-k, so that no task sends more than
    its share however many tasks there are.
    """
    total = df.count()
    h = F.xxhash64(*cols, F.lit(seed))
    if total > 2 * n + 64:
        df = df.where(F.pmod(h, F.lit(1 << 30)) < int((2 * n + 64) / total * (1 << 30)))
    return df.orderBy(F.pmod(h, F.lit(1 << 30)), *cols).limit(n)
