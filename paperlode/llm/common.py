"""Shared helpers: tables in the shared folder, text keys and bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import new_path, remove

_scopes = threading.local()
#: What a Python worker keeps from one task for later ones.
_kept: dict[Hashable, Any] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage and survives lost executors.

    Inside distilled, the table goes when that is done; else, when the driver ends.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    scope = getattr(_scopes, "paths", None)
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def distilled(spark: SparkSession, tag: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The saved result of build; tables that were saved on the way to it are deleted, also where
    it fails. Each thread has tables of its own."""
    outer, inner = getattr(_scopes, "paths", None), []
    _scopes.paths = inner
    try:
        df = build()
        _scopes.paths = outer
        return saved(df, tag)
    finally:
        _scopes.paths = outer
        for path in inner:
            remove(spark, path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs: it does so when the driver's JVM has
    collected the objects that stand for them, which by itself may take half an hour."""
    spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What make gives, made once for the tasks of a Python worker, until it has a lean task that does
    not keep."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def _forget() -> None:
    # by name: a function that Spark sends along would have a copy of _kept
    _kept.clear()


def _give_back() -> None:
    """Freed memory that Arrow's pool and the C library hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run: Callable[[Batches], Batches], keeps: bool = False) -> Callable[[Batches], Batches]:
    """run for mapInArrow. Spark's Python workers outlive their tasks and serve all operators: what
    others have kept in one goes first unless keeps, and after each batch so does freed memory."""

    def lean_run(batches: Batches) -> Batches:
        def each() -> Batches:
            for batch in batches:
                yield batch
                del batch
                _give_back()

        if not keeps:
            _forget()
        yield from run(each())
        _give_back()

    return lean_run


def text_key(text: Column) -> Column:
    """128-bit key of a text; equal texts have equal keys at any corpus size."""
    return F.unhex(F.md5(text.cast("binary")))


def free_name(columns: list[str], name: str) -> str:
    """name, or a longer one, that is none of columns in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: pa.Array, max_bytes: int) -> Iterator[pa.Array]:
    """Cuts a string array into runs of rows of at most max_bytes (one row may exceed it)."""
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > max_bytes:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield texts.slice(start)
