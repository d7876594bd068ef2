"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import scratch_path
from silverline.sources.fs import _fs_and_path


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(folds)


def held_out(id_col: Column, folds: int, kept_out: int) -> Column:
    """True for rows outside the training folds; a null id is never held out."""
    return F.coalesce(fold(id_col, folds) == F.lit(kept_out), F.lit(False))


def batches_of(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with rows only."""
    for b in batches:
        if b.num_rows:
            yield b


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else (and whatever case) the input carries."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def packed(x: np.ndarray) -> bytes:
    """A numeric array as compressed byte planes."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(raw: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, len(planes) // width).T).reshape(-1).view(dtype)


# Bytes of an Arrow batch. Rows to Python tasks go by thousands otherwise, tens of MB at a time on both sides.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python tasks in batches of bounded bytes, from here on (plans are made when they run)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Scratch:
    """Tables of one run, under one folder of the shared checkpoint directory."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, scratch_path(spark, label)

    def stored(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        (df.write.partitionBy(by) if by else df.write).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str | None = None) -> None:
        """All of it, or one table or part of a table."""
        fs, path = _fs_and_path(self.spark, f"{self.path}/{name}" if name else self.path)
        fs.delete(path, True)
