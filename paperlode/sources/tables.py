"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Where that setting is unset and all runs in one process (tests), a temporary folder stands in
    and is removed at exit. A cluster without that setting is an error: its executors have no
    folder in common.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = tempfile.mkdtemp(prefix="paperlode-")
        atexit.register(shutil.rmtree, _folders[app], ignore_errors=True)
    return f"file://{_folders[app]}"


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # what is left of a table, or of a session that has ended, does no harm
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in a folder of this application's own, which goes when the driver ends."""
    folder = f"{shared_dir(spark)}/paperlode-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders[folder] = folder
        atexit.register(remove, spark, folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


#: Bytes of input files for one task of a shuffle: rows of them take some 20 times that in a sort.
TASK_BYTES = 8 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that df is made from, each time that it reads them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # more says that it is not known


def task_number(df: DataFrame) -> int:
    return -(-input_bytes(df) // TASK_BYTES)


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """df dealt by keys to n tasks, if that is more than the session's number of shuffle partitions, which
    does not grow with the tables; else as it is."""
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to as many tasks as its input needs."""
    return dealt(df, task_number(df), *keys)


def stored(df: DataFrame, tag: str = "table") -> DataFrame:
    """df as a Parquet table in the shared folder: made once, whatever is made from it, and there still
    when an executor is lost."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
