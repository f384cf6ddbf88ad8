"""Shared plumbing: table access and bounded text chunks; scratch tables are those of the library."""

from __future__ import annotations

import ctypes
import inspect
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut, drop_table, finish, free_shuffles, scratch_dir  # noqa: F401

#: Characters of text that one chunk holds before it is processed.
CHUNK_CHARS = 2_000_000
#: Rows and bytes of one Arrow batch sent to Python; a batch ends at whichever comes first, but holds one row at least.
BATCH_ROWS = 500
BATCH_BYTES = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns needed, so clashing names elsewhere never matter; null text is empty."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session; texts may be long. (Spark reads the setting when a plan runs.)"""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def give_back() -> None:
    """Return memory that this worker has freed to the system; workers are kept for later stages."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library is glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable) -> Callable:
    """A function over batches, or over tables, that gives its memory back at its end."""

    def over_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    def over_group(group: pa.Table) -> pa.Table:
        out = run(group)
        give_back()
        return out

    def over_groups(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        give_back()
        return out

    if inspect.isgeneratorfunction(run):
        return over_batches
    return over_group if len(inspect.signature(run).parameters) == 1 else over_groups


def spread(df: DataFrame, least: int = 1 << 26) -> DataFrame:
    """Rows of files over all cores, where there are fewer files than cores and little to move; large inputs have splits
    enough."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < least * cores and len(df.inputFiles()) < cores else df


#: Keys that hold more than one row in so many are frequent; fewer than so many keys can be.
FREQUENT = 1_000


def join_frequent(rows: DataFrame, keyed: DataFrame, on: list[str], n: str, total: int) -> DataFrame:
    """rows joined with keyed, which has one row a key and in column n the number of rows with it, out of total.

    Frequent keys, whose number is bounded, are broadcast to where their rows are, so no task gathers the rows of one.
    """
    often = F.col(n) * FREQUENT > total
    few, rest = F.broadcast(keyed.where(often)), keyed.where(~often)
    common = rows.join(few, on)
    return common.unionByName(rows.join(F.broadcast(keyed.where(often).select(*on)), on, "left_anti").join(rest, on))


def power_of_two(n: float, least: int = 1) -> int:
    return max(least, 1 << max(0, int(np.ceil(np.log2(max(n, 1))))))


def text_chunks(batches: Iterable[pa.RecordBatch], max_chars: int = CHUNK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of the first two columns, a bounded number of characters at a time (a longer text is alone)."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py() or ""
            if texts and size + len(t) > max_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
        if texts:
            yield ids, texts


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls end to end, and where each row begins (and the last ends)."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def held_out_expr(id_col: str = "doc_id") -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.expr(f"pmod(crc32(cast({id_col} as string)), 3) = 1"), F.lit(False))


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
