"""Tables written to the folder that driver and executors share, and the reading of text columns in tasks."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, one of our own, but only if driver and executors are one
    process, as in tests: on a cluster other machines would not see it."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = context.getCheckpointDir()
    return folder


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and still there when an executor is lost.

    As zstd, which is small and works in the heap; other codecs hold on to direct memory for each column and file.
    """
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over batches; when a task has ended, what its arrays took goes back to the system, as workers live on from stage
    to stage beside the executor's heap."""
    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        # Only the C library of Linux has it.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 bounds of its texts in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (data[bounds[0] : bounds[-1]], bounds - bounds[0]) if len(column) else (data[:0], np.zeros(1, np.int64))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `most` bytes of text each, a longer text alone: what one step holds stays bounded."""
    sizes = pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield batch.slice(first)
    # What earlier steps held goes back, as workers live on from stage to stage.
    pa.default_memory_pool().release_unused()


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal numbers in the key columns; one is held at a time."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not len(batch):
            continue
        values = np.stack([batch[k].to_numpy() for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            key = values[:, a].tolist()
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
