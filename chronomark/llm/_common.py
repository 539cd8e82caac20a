"""Helpers that the operators share: table access, shared storage, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
import os
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH_BYTES = 4_000_000
_LOCAL_ROOT: list[str] = []
_LOCK = threading.Lock()
_COUNTER = itertools.count()
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting (unit tests) gets a temporary folder; a cluster's raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        with _LOCK:
            if not _LOCAL_ROOT:
                _LOCAL_ROOT.append("file://" + tempfile.mkdtemp(prefix="chronomark-"))
        root = _LOCAL_ROOT[0]
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under this application's own part of the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/chronomark/{app}/{next(_COUNTER):05d}-{uuid.uuid4().hex[:8]}-{name}"


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def without_shuffle_files(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Shuffle files of what is run inside go when it has run, not when the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def in_small_batches(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Python gets rows in batches of ``BATCH_BYTES``; else a task's rows can be one batch, which the JVM and Python both hold whole."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, nothing is kept on one executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, rows: int, per_partition: int, least: int = 1) -> int:
    """Partition count in proportion to the rows, so that a task's share stays bounded at any size."""
    return max(least, -(-rows // per_partition))


def slots(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


def record_batches(schema: pa.Schema, columns: dict[str, list], rows: int, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    if not rows:
        return
    whole = pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
    for at in range(0, rows, most):
        yield whole.slice(at, most)


def open_filesystem(uri: str):
    """``(pyarrow filesystem, path)`` of a URI; reads by range work on every store pyarrow knows."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def discard(uri: str) -> None:
    """Remove an intermediate folder that nothing reads any more, if it is there."""
    from pyarrow import fs

    store, path = open_filesystem(uri)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)


_CACHES: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """What a Python worker keeps between tasks, for one operator at a time: a worker that turns to another drops it, and its memory goes back to the system."""
    if name not in _CACHES:
        _CACHES.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)
    return _CACHES.setdefault(name, {})


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, in order."""
    x = a * _U(0x9E3779B97F4A7C15) + ((b << _U(31)) | (b >> _U(33))) * _U(0xC2B2AE3D27D4EB4F)
    x ^= x >> _U(29)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(32)
    return x


def as_bytes(values: Iterable) -> list[bytes]:
    """Texts of an Arrow binary column as bytes; null counts as empty."""
    return [v if v is not None else b"" for v in values]


def keep_named_rows(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``classes(rep_id, rep_hash)`` names by doc_id and xxhash64 of the text, each once, with all columns.

    Of rows that are equal in doc_id and text the one whose other columns hash least stays. Texts are shuffled once, by one
    key for the join and for what is left double. Columns named ``__id``, ``__hash``, ``__row``, ``__text``, ``__all`` or ``__n`` are not allowed.
    """
    name = lambda i, h: F.xxhash64(i.isNull(), i, h)
    keep = classes.select(name(F.col("rep_id"), F.col("rep_hash")).alias("__row"), F.col("rep_id").alias("__id"), F.col("rep_hash").alias("__hash")).distinct()
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    hashed = docs.withColumn("__text", F.xxhash64("text")).withColumn("__row", name(docs["doc_id"].cast("long"), F.col("__text"))).withColumn("__all", F.xxhash64(*others))
    same = (hashed["__row"] == keep["__row"]) & hashed["doc_id"].eqNullSafe(keep["__id"]) & (hashed["__text"] == keep["__hash"])
    kept = hashed.join(keep, same, "left_semi")
    once = kept.withColumn("__n", F.row_number().over(Window.partitionBy("__row").orderBy("__all"))).where("__n = 1")
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
