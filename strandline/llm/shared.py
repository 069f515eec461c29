"""Helpers that the operators of this folder share: tables, the shared folder, file systems, batches, hashes.

Tables that an operator needs only while it runs lie in a ``Scratch``, whose ``close`` deletes them. What a result is read
from (archives, records, chat segments, the stages' tables of the pipeline) stays in the shared folder (``strandline.sources.held``).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources.held import hold as cut
from strandline.sources.held import shared_folder


#: Files of a small table at least, and rows of a file, where the number of rows is known.
FEW_FILES = 8
FILE_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the folder ``sf_dir``, read by Spark (so any store that Spark reaches will do)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables of a running operator, in a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count = spark, shared_folder(spark, name), 0

    def cut(self, df: DataFrame, most: int | None = None) -> DataFrame:
        """``df`` written and read again; a table of at most ``most`` rows in no more files than these need."""
        self.count += 1
        return cut(df if most is None else df.coalesce(max(FEW_FILES, most // FILE_ROWS)), f"{self.folder}/{self.count}")

    def close(self) -> None:
        """Deletes the tables; what was made from them must have been written by then."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def steady(df: DataFrame) -> DataFrame:
    """``df`` if its tasks read files in their order and so give the same rows again; else it is written first.

    Row numbers of tasks (``monotonically_increasing_id``) hold over a task that runs again only on such rows.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return cut(df) if any(x in plan for x in ("Exchange", "Join", "Limit", "InMemoryTableScan")) else df


def file_system(uri: str):
    """(file system, path) of a URI, in any store that Arrow reaches: local, hdfs, s3, gs."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def texts(name: str = "text") -> Column:
    """The column as text, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` has it: for columns that only an operator sees."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def pieces_of(batch: pa.RecordBatch, column: str, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most about ``most`` bytes in ``column`` each (a longer single row stays whole)."""
    for a, b in slices(batch.column(column), most):
        yield batch.slice(a, b - a)


def slices(values: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """[start, end) of slices of a string array with at most about ``most`` bytes each (a longer single value stays whole)."""
    ends = np.cumsum(pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(values):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to


def flat_bytes(values: pa.Array):
    """(bytes as uint8 array, offsets from 0) of a string or binary array without nulls, without a copy of the text."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def no_nulls(values: pa.Array) -> pa.Array:
    """A string array with nulls as empty texts, as one array."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.fill_null("") if values.null_count else values


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64: 64 well-spread bits from 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release() -> None:
    """Gives a worker's free memory back to the system: workers stay for later tasks, and others run beside them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # no glibc
