"""Small file-system helpers over the session's Hadoop FileSystem.

Used only for metadata-sized work on the driver (commit-log files of
versioned datasets, directory listings). Data itself is always read and
written by Spark tasks. Going through Hadoop's FileSystem means every scheme
the cluster is configured for (hdfs://, s3a://, abfs://, file:) works.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm  # noqa: SLF001 - public py4j gateway


def _fs_and_path(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Create `path` with `text`. With overwrite=False an existing file makes
    the call fail, which is what a commit needs (no silent clobbering)."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_and_path(spark, path)
    jvm = _jvm(spark)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def qualified(spark: SparkSession, path: str) -> str:
    """Fully qualified URI of `path` (e.g. file:/..., hdfs://nn/...)."""
    fs, p = _fs_and_path(spark, path)
    return str(fs.makeQualified(p).toString())
