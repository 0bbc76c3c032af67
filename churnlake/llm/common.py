"""Helpers the operators share: table paths, Arrow task helpers, identifiers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters (upper bound) a task hands to one vectorised step; a single longer text is a step of its own.
STEP_CHARS = 8_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that
    tasks can import it wherever the driver found it."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="churnlake-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))      # served by the driver, no shared folder needed
    _shipped.add(spark.sparkContext.applicationId)


def in_tasks(fn: Callable, schema) -> Callable[[DataFrame], DataFrame]:
    """For ``DataFrame.transform``: run ``fn`` over the Arrow batches of every partition."""
    def apply(df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        return df.mapInArrow(fn, schema)

    return apply


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by the bytes of ``column`` so that a task's working
    memory does not depend on how many rows Spark puts into a batch."""
    for b in batches:
        if b.num_rows == 0:
            continue
        c = b.column(b.schema.get_field_index(column))
        if c.nbytes <= limit:
            yield b
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < b.num_rows:
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield b.take(pa.array(np.arange(start, end)))      # a copy: kernels then see whole arrays without offsets
            start = end


def texts_of(column: pa.Array) -> pa.Array:
    """A string column without nulls (null counts as empty)."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def list_offsets(lists: pa.Array) -> np.ndarray:
    """Row borders (n + 1) of a list array's flattened values."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate(([0], np.cumsum(n)))
