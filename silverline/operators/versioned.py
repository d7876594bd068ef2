"""Batches of an ordinary Parquet table.

A table is a Parquet folder partitioned by `batch`: every load appends one
batch, and nothing is rewritten. Reading up to a batch is a partition filter
(pruned at listing), so an earlier state is the same read with another bound.
Columns that a later batch adds are null in the earlier ones (schema merging). A
batch is taken back by overwriting its folder with no rows.

This is plain DataFrame use, not a table format: there is no commit protocol,
so give each batch one writer. A batch is written with overwrite into its own
folder, so a repeated load of the same batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BATCH = "batch"


def write_batch(df: DataFrame, root: str, batch: int) -> None:
    """V1/V2/V8: store `df` as one batch of the table at `root`."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{BATCH}={batch}")


def read_batches(spark: SparkSession, root: str, upto: int | None = None, keep_batch: bool = False) -> DataFrame:
    """V5: the table, or its state after batch `upto`; columns of all batches (V7)."""
    rows = spark.read.option("mergeSchema", "true").parquet(root)
    if upto is not None:
        rows = rows.where(F.col(BATCH) <= upto)
    return rows if keep_batch else rows.drop(BATCH)


def take_back(spark: SparkSession, root: str, batch: int) -> None:
    """V6: undoes one load for every later read. Its folder is overwritten with
    an empty batch that has the columns of the other loads, so a column that only
    it had added goes as well. The rows are gone; load the batch again to redo it."""
    root = root.rstrip("/")
    others = [r[0] for r in read_batches(spark, root, keep_batch=True).where(F.col(BATCH) != batch).select(BATCH).distinct().collect()]  # one a load
    if not others:
        raise ValueError("the only batch of a table cannot be taken back")
    kept = spark.read.option("mergeSchema", "true").parquet(*[f"{root}/{BATCH}={b}" for b in others])
    write_batch(spark.createDataFrame([], kept.schema), root, batch)


def with_null_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """V7: the rows with one more, empty column."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    return df.withColumn(name, F.lit(None).cast(kind))


def batch_summary(spark: SparkSession, root: str) -> DataFrame:
    """V3: batch, the batch before it, rows added and rows in total, counted from the data."""
    per = read_batches(spark, root, keep_batch=True).groupBy(BATCH).agg(F.count(F.lit(1)).alias("added_records"))
    # one row per load: a window over as many rows as there were batches
    order = Window.orderBy(BATCH)
    return per.select(
        BATCH, F.lag(BATCH).over(order).alias("parent"), "added_records",
        F.sum("added_records").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("total_records"))


def batch_files(spark: SparkSession, root: str) -> DataFrame:
    """V4: files with their batch, record count and size."""
    rows = read_batches(spark, root, keep_batch=True)
    return rows.groupBy(BATCH, F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_size").alias("file_size_in_bytes")).agg(F.count(F.lit(1)).alias("record_count"))


def key_collisions(new_rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `new_rows` already present in `table`. The table is
    reduced to the new keys first (a semi join whose right side is the small
    load, which AQE broadcasts), and only what is left is made distinct."""
    return table.select(*keys).join(new_rows.select(*keys), keys, "left_semi").distinct()


def guarded_append(spark: SparkSession, root: str, new_rows: DataFrame, keys: list[str], batch: int) -> None:
    """Append a batch only if no key collides (looks at one colliding row at most)."""
    if key_collisions(new_rows, read_batches(spark, root), keys).take(1):
        raise ValueError("append would duplicate existing keys")
    write_batch(new_rows, root, batch)
