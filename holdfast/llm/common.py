"""What the operators of this subpackage share: scratch tables, row keys and slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..sources.scratch import materialise, release, scratch_path, shared_dir

__all__ = ["importable", "materialise", "partitions", "release", "row_key", "scratch", "shared_dir", "slices", "texts"]

#: Bytes of text that a Python worker turns into objects at a time.
SLICE_BYTES = 2 << 20
#: What a task may hold: Spark's own bounds, and ours. An Arrow batch between Spark and a worker (its buffers double as they grow, so tasks would hold
#: some times 64 MB); rows that the Parquet reader decodes at once, as doubling arrays; a row group, which the writer keeps until it is whole. With
#: Spark's own, eight tasks over long texts fill a heap of 1 GB.
BOUNDS = {"spark.sql.execution.arrow.maxBytesPerBatch": (64 << 20, 4 << 20), "spark.sql.parquet.columnarReaderBatchSize": (4096, 256), "parquet.block.size": (128 << 20, 8 << 20)}
#: Rows after which the writer looks at the size of its page and of its row group, at least and at most. With Spark's own, 100 long texts, or more after
#: short ones, make up a page and a row group, whatever their bounds.
BOUNDS |= {"parquet.page.size.row.check.min": (100, 1), "parquet.page.size.row.check.max": (10_000, 4)}


def importable(spark: SparkSession) -> None:
    """Let workers import this package, and set BOUNDS unless the session has bounds of its own."""
    session.importable(spark)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for setting, (default, bound) in BOUNDS.items():
        if spark.conf.get(setting, hadoop.get(setting, str(default))).rstrip("b") == str(default):
            spark.conf.set(setting, str(bound))


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return scratch_path(spark, name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(*cols: str) -> list[Column]:
    """128 bits that identify a row by its content, nulls included; equal rows have equal keys."""
    cells = [F.struct(F.col(c).isNull(), F.col(c)) for c in cols]
    return [F.xxhash64(*cells).alias("key_a"), F.xxhash64(F.lit("second half"), *cells).alias("key_b")]


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the column holds at most limit bytes in each, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
