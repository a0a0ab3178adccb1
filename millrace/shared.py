"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: The folder that stands in where none is set, for each local application.
_local: dict[str, str] = {}
#: The folder of the ``temporary_tables`` around.
_inside: ContextVar[str | None] = ContextVar("inside", default=None)
#: Where each table that ``written`` returned is.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset and Spark runs in one local process, a temporary folder."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    name = spark.sparkContext.applicationId
    if name not in _local:
        folder = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local[name] = f"file://{folder}"
    return _local[name]


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file, or a folder with all in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of what is in a folder, sorted; none where it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(where)) if files.exists(where) else []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all that ``written`` wrote inside.

    DataFrames made inside may read these tables, so results that are to stay
    are written elsewhere before the end.
    """
    folder = f"{_inside.get() or shared_folder(spark)}/run-{uuid.uuid4().hex}"
    outer = _inside.set(folder)
    try:
        yield
    finally:
        _inside.reset(outer)
        delete(spark, folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    What follows doesn't compute it again, neither for a second use nor after
    the loss of an executor.  It stays until ``forget`` or the end of the
    ``temporary_tables`` around, else until the folder is cleaned.
    """
    path = f"{_inside.get() or shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def forget(table: DataFrame) -> None:
    """Deletes a table that ``written`` returned, once all that is made of it is written itself."""
    delete(table.sparkSession, _paths.pop(table))
