"""Tables that cut lineage: written once to the folder that driver and executors share, and deleted once they are read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN = "_holdfast_scratch"
_scopes: list[list[tuple[SparkSession, str]]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a local session without one, a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="holdfast-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/holdfast/{name}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append((spark, path))
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(out, _OWN, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(*tables: DataFrame) -> None:
    """Delete tables that `materialise` has returned, once all that is made of them is written itself."""
    for df in tables:
        _delete(df.sparkSession, getattr(df, _OWN))


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Delete on leaving what was written to the shared folder inside; results must have been read or written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for spark, path in _scopes.pop():
            _delete(spark, path)
