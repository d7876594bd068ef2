"""Parquet sinks and file layout.

Layout choices are made for scale:
* partitioned writes are rebalanced by the partition columns: AQE splits a hot
  value (a third of the rows) over as many writers as its bytes need and packs
  small values together, with no fixed fan-out;
* range-clustered writes sort within range partitions so row-group min/max
  statistics prune date filters;
* file inventories read the listing; file profiles are aggregations by the file
  that a row is read from.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.catalog import scratch_path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1."""
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str],
                      mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> None:
    """K4/K5: `partitionBy(columns)` after a rebalance on the same columns; AQE
    sizes the writer partitions at run time."""
    (df.hint("rebalance", *[F.col(c) for c in columns])
       .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*columns).parquet(path))


def with_month(df: DataFrame, ts: str, name: str = "month") -> DataFrame:
    return df.withColumn(name, F.trunc(F.to_date(ts), "MM"))


def write_range_clustered(df: DataFrame, path: str, column: str, partitions: int | None = None,
                          mode: str = "overwrite") -> None:
    """K9: range partitions on `column`, sorted within each, so every file
    and row group covers a narrow [min, max] and range filters skip the rest.
    repartitionByRange samples to find bounds (no full sort job)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, F.col(column)).sortWithinPartitions(column).write.mode(mode).parquet(path)


def partition_balance(df: DataFrame, n: int) -> DataFrame:
    """Rows per partition after a shuffle `repartition(n)` and after a
    shuffle-free `coalesce(n)`."""
    def rows(frame, method):
        return frame.groupBy(F.spark_partition_id().alias("partition")).agg(
            F.count(F.lit(1)).alias("rows")).withColumn("method", F.lit(method))

    return rows(df.repartition(n), "repartition").unionByName(rows(df.coalesce(n), "coalesce"))


def materialize(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """A view re-executes its plan on every read; a table stores the
    rows (here: Parquet under the shared checkpoint folder) and reads them."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "table":
        path = scratch_path(df.sparkSession, f"table-{name}")
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    raise ValueError(kind)


def file_inventory(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """K7/V4: output files with size and record count (per-file aggregate of
    the hidden `_metadata` column)."""
    df = spark.read.format(fmt).load(path)
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size_in_bytes"),
    ).agg(F.count(F.lit(1)).alias("record_count"))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """File listing as a DataFrame (path, length). The binaryFile source does
    not read file contents when `content` is not selected."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path).select("path", "length"))




def file_profile(spark: SparkSession, path: str) -> DataFrame:
    """K8, re-aimed: per file and column of a Parquet table its type, rows, nulls,
    least and largest value as text, from the data (codecs and byte sizes of column
    chunks are of the storage format and not told). One aggregation by file."""
    table = spark.read.parquet(path)
    fields = [(f.name, f.dataType.simpleString()) for f in table.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    wide = table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(F.count_if(F.col(f"`{n}`").isNull()).alias("nulls"), F.min(f"`{n}`").cast("string").alias("least"),
                 F.max(f"`{n}`").cast("string").alias("largest")).alias(f"c{i}") for i, (n, _) in enumerate(fields)])
    return wide.select("file_path", "rows", F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("column_type"), F.col(f"c{i}.nulls").alias("nulls"),
                 F.col(f"c{i}.least").alias("least"), F.col(f"c{i}.largest").alias("largest")) for i, (n, k) in enumerate(fields)])).alias("p")
    ).select("file_path", "rows", "p.*")


def rows_per_file(spark: SparkSession, path: str) -> DataFrame:
    """K8, re-aimed: rows of every file of a table, by the file they are read from."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file_path"),
                                            F.col("_metadata.file_size").alias("file_size_in_bytes")).agg(F.count(F.lit(1)).alias("rows"))
