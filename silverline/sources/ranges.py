"""Byte verification of large landed files by ranges.

A digest of a whole file is one task's work, however large the file, and says
only that something differs. Here a file is cut into ranges of bytes, each with
a digest of the lines that begin in it: files are read by the text source, so by
many tasks each, through the session's own file system, and a difference is told
with its place.

A task knows a line's place in its block only. The places of the blocks follow
from a prefix sum over one row a block, as many bytes as the lines before it, so
the digests do not depend on how files were split. A range's digest is two 64-bit
sums by exclusive or over its lines of hashes of (place, line): partial sums are
combined before the shuffle, and lines need no order.

For text files with \\n line ends (other bytes are compared as they are); a line
is the smallest unit. The file's length is compared too, so a missing last line
end is found. Against chance errors, not against an adversary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from silverline.catalog import stored

RANGE = 1 << 20


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of bytes between a block's first line and each line."""
    here, passed = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, block, size = (batch.column(c) for c in ("file", "block", "size"))
        changes = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
        sizes, at = size.to_numpy(zero_copy_only=False), np.zeros(n, np.int64)
        for low, high in zip(edges[:-1], edges[1:]):
            if here != (now := (file[low].as_py(), block[low].as_py())):
                here, passed = now, 0
            ends = passed + np.cumsum(sizes[low:high])
            at[low:high] = ends - sizes[low:high]
            passed = int(ends[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "at"])


def line_places(spark: SparkSession, path: str, size: int = RANGE, name: str = r"([^/]+)$", also: dict[str, Column] | None = None) -> DataFrame:
    """file (the group of `name` in its path), range, place, bytes, two hashes and the file's length of every line, and
    the columns `also` made of its `value`."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("length"), "value")
    lines = lines.select(F.regexp_extract("path", name, 1).alias("file"), "block", "length", (F.octet_length("value") + 1).cast("bigint").alias("size"),
                         F.xxhash64("value").alias("h1"), F.xxhash64(F.lit(1), "value").alias("h2"), *[c.alias(k) for k, c in (also or {}).items()])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema.fields) + ", at bigint"
    found = stored(lines.mapInArrow(_placed, schema), "line-places")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
                    .select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before")), "line-blocks")
    place = F.col("before") + F.col("at")
    return found.join(blocks, ["file", "block"]).select("file", F.floor(place / size).cast("bigint").alias("range"), place.alias("place"),
                                                        F.col("size").alias("bytes"), "h1", "h2", "length", *(also or {}))


def range_digests(places: DataFrame) -> DataFrame:
    """file, range, lines, bytes, d1, d2, length of the lines of `line_places`."""
    return places.groupBy("file", "range").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("bytes").alias("bytes"), F.max("length").alias("length"),
        F.bit_xor(F.xxhash64("place", "h1")).alias("d1"), F.bit_xor(F.xxhash64("h2", "place")).alias("d2"))


def compared_ranges(left: DataFrame, right: DataFrame, size: int = RANGE) -> DataFrame:
    """file, range, start, lines and status (equal, differs, left_only, right_only) of the ranges of two `range_digests`.
    Lines that were moved by an inserted or lost byte differ in all later ranges of their file."""
    l, r = left.alias("l"), right.alias("r")
    both = l.join(r, (F.col("l.file") == F.col("r.file")) & (F.col("l.range") == F.col("r.range")), "full_outer")
    same = (F.col("l.d1") == F.col("r.d1")) & (F.col("l.d2") == F.col("r.d2")) & (F.col("l.bytes") == F.col("r.bytes")) & (F.col("l.length") == F.col("r.length"))
    status = (F.when(F.col("r.file").isNull(), "left_only").when(F.col("l.file").isNull(), "right_only")
              .when(same, "equal").otherwise("differs"))
    number = F.coalesce("l.range", "r.range")
    return both.select(F.coalesce("l.file", "r.file").alias("file"), number.alias("range"), (number * size).alias("start"),
                       F.coalesce("l.lines", "r.lines").alias("lines"), status.alias("status"))


def verify_ranges(spark: SparkSession, source: str, landed: str, size: int = RANGE, name: str = r"([^/]+)$") -> DataFrame:
    """The ranges of two folders of text files, compared."""
    left, right = (range_digests(line_places(spark, p, size, name)) for p in (source, landed))
    return compared_ranges(left, right, size)
