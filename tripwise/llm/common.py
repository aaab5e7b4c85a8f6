"""Small helpers the operators share: written intermediates, per-worker
caches and file access for the formats Spark has no writer for."""

from __future__ import annotations

import contextlib
import sys
import types
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.session import scratch_path

#: Characters that separate words; the word pattern is their complement.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and
    a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    the body or a lambda inside it refers to it."""
    return F.transform(F.array(value), body)[0]


def worker_cache(key, make):
    """``make()``, kept for the life of the Python worker.  Task functions
    are unpickled anew for every task, so module globals would not last."""
    module = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    store = module.__dict__.setdefault("store", {})
    if key not in store:
        store[key] = make()
    return store[key]


def lean(batches, keep: bool = False):
    """``batches`` of a task in a worker that lives on: unless ``keep``, what
    ``worker_cache`` holds from other stages goes before the first batch, and
    the memory that Arrow has no more use for goes back after the last."""
    if not keep and "_llm_worker_cache" in sys.modules:
        sys.modules["_llm_worker_cache"].__dict__.get("store", {}).clear()
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, chunks) -> int:
    """Write the byte chunks to ``uri``: into a file of this attempt first,
    then moved in place, so that readers only see whole files and a retried
    task replaces its own output.  Returns the file's size."""
    fs, path = file_system(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    context = TaskContext.get()
    attempt = f"{path}.{context.taskAttemptId() if context else 0}-{uuid.uuid4().hex[:8]}.part"
    size = 0
    with fs.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(attempt, path)
    return size


def rows_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
         for f in schema], schema=schema)


def int_column(column: pa.Array):
    """Values and null flags of an integer Arrow column."""
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False), nulls


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 16 << 20) -> None:
    """Bound the Arrow batches handed to Python by rows and by bytes, so that
    very long texts come in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int = 2000, size: int = 16 << 20):
    """Bounded Arrow batches for the jobs run inside; the session's own
    bounds hold again after it."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(n) for n in names]
    bounded_batches(spark, rows, size)
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
