"""What the operators share: stored tables, byte-level words, Arrow rows."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import orderloom
from orderloom.session import work_area

# A-Z to a-z, every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, as --py-files would."""
    context = spark.sparkContext
    if getattr(context, "_orderloom_shipped", False):
        return spark
    home = Path(orderloom.__file__).parent
    handle, archive = tempfile.mkstemp(prefix="orderloom-", suffix=".zip")
    with os.fdopen(handle, "wb") as to, zipfile.ZipFile(to, "w") as z:
        for file in sorted(home.rglob("*.py")):
            z.write(file, str(file.relative_to(home.parent)))
    context.addPyFile(archive)
    context._orderloom_shipped = True
    return spark


def stored(df: DataFrame, purpose: str, narrow: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends here.

    A `narrow` table, of ids and numbers only, is written by two tasks per core at most:
    what would be many tiny files otherwise.
    """
    path = work_area(df.sparkSession, purpose)
    if narrow:
        df = df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frugal(task):
    """A task that gives its memory back when it ends: Python workers outlive their tasks."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def hash_sample(df: DataFrame, rows: int, key: str) -> DataFrame:
    """At most `rows` rows, the same each time: those with the smallest hash of `key`.

    The count first, so that few rows beyond the asked ones are sorted, however large the table.
    """
    share = min(1.0, (1.2 * rows + 100) / max(1, df.count()))
    near = df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else df
    return near.orderBy(F.xxhash64(key), key).limit(rows)


def with_columns(df: DataFrame, ddl: str) -> StructType:
    """The schema of a table and further columns."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def utf8(column: pa.Array) -> list[bytes]:
    """A text column as bytes; null becomes the empty text."""
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    return column.to_pylist()


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that one text column holds about `limit` bytes in each part."""
    sizes = np.diff(offsets(batch.column(column))) if batch.num_rows else []
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a string column, one more than it has rows."""
    column = column.cast(pa.large_string()).fill_null("")
    raw = np.frombuffer(column.buffers()[1], np.int64)
    return raw[column.offset : column.offset + len(column) + 1]


def binaries(data: bytes | np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column over one buffer; `ends` are byte positions, the first at 0."""
    raw = data if isinstance(data, bytes) else data.tobytes()
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(raw)]
    ).cast(pa.binary())


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Bytes that print stand for themselves, the others for the characters from 256 on.
    """
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)).difference(prints))
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(rest)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
