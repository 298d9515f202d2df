"""Shared folder, written tables and small helpers of the training-data operators."""

from __future__ import annotations

import inspect
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of an Arrow batch on its way to Python; one row may be larger.
BATCH_ROWS, BATCH_BYTES = 512, 32 << 20


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, most_bytes: int = BATCH_BYTES) -> None:
    """Lower the session's bounds on Arrow batches, in rows and bytes, where they are larger.

    The setting stays: plans read it when they run, which is after the call that made them.
    """
    for key, bound in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", most_bytes)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).rstrip("bB"))
        if not 0 < now <= bound:
            spark.conf.set(key, str(bound))


#: Folders made by this process, in order, until forgotten() removes them.
_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir; where that is unset, under a folder of our own on a local master.

    On a cluster, executors and driver share no folder but the one that is set, so an unset one is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(base)
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def mark() -> int:
    """Stands for all folders made so far."""
    return len(_made)


def forgotten(spark: SparkSession, since: int, keep: DataFrame | None = None) -> None:
    """Remove the folders made after a mark but those that `keep` reads: for when nothing else reads them any more."""
    used = [f.rsplit("/", 1)[0] for f in keep.inputFiles()] if keep is not None else []
    used = [u.split(":", 1)[-1].lstrip("/") for u in used]
    jvm = spark.sparkContext._jvm
    left = []
    for folder in _made[since:]:
        if folder.split(":", 1)[-1].lstrip("/") in used:
            left.append(folder)
            continue
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _made[since:] = left


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: the lineage ends there."""
    spark = session(df)
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str):
    """pyarrow file system and path of a folder given as plain path, file: or other URI."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if "://" not in uri:
        return LocalFileSystem(), os.path.abspath(uri.removeprefix("file:"))
    return FileSystem.from_uri(uri)


def put_file(folder: str, name: str, parts: Iterator[bytes]) -> int:
    """Write a file under a name of its own, then move it in place: a task that is repeated replaces it whole."""
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    size = 0
    with fs.open_output_stream(part) as out:
        for x in parts:
            out.write(x)
            size += len(x)
    fs.move(part, f"{path}/{name}")
    return size


def open_file(folder: str, name: str):
    fs, path = filesystem(folder)
    return fs.open_input_file(f"{path}/{name}")


def source_rows(df: DataFrame, id_col: str, *cols: tuple[str, str, str]) -> DataFrame:
    """Only the named columns, as "id" long and each (column, name, type): other columns can't clash."""
    return df.select(F.col(id_col).cast("long").alias("id"), *(F.col(c).cast(t).alias(n) for c, n, t in cols))


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and text; a null text counts as empty."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


_collected = 0.0


def tidy(every: float = 1.0) -> None:
    """Give freed memory back to the system: Spark keeps Python workers for the next stage, beside its own heap.

    Cycles are collected once in `every` seconds at most: small groups follow each other fast.
    """
    import ctypes
    import gc

    global _collected
    if time.monotonic() - _collected >= every:
        gc.collect()
        _collected = time.monotonic()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidied(run):
    """A function over batches or over one group's rows that tidies up when it is through."""

    @wraps(run)
    def over_batches(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    @wraps(run)
    def over_group(rows):
        try:
            return run(rows)
        finally:
            tidy()

    @wraps(run)
    def over_two_groups(left, right):
        try:
            return run(left, right)
        finally:
            tidy()

    if inspect.isgeneratorfunction(run):
        return over_batches
    return over_group if len(inspect.signature(run).parameters) == 1 else over_two_groups


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that none holds more than about most_bytes, or one row."""
    for b in batches:
        n = max(1, -(-b.nbytes // most_bytes))
        step = max(1, -(-b.num_rows // n)) if b.num_rows else 1
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def partitions_for(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
