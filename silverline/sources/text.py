"""Delimited text and CSV sources.

CSV options that keep a round trip exact (the studied generator writes
Python-csv quoting: doubled quotes, quoted multi-line fields):
`escape='"'` so `"x ""q"" y, z"` is one field, and no white-space trimming
on either side. `multiLine` makes a file unsplittable, so land many
moderate files rather than one huge one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none", file_rows: int = 0) -> None:
    """K6: CSV with header and exact-round-trip quoting. A compressed file is read
    by one task; `file_rows` bounds its rows (0: no bound)."""
    df.write.mode(mode).options(**CSV_OPTIONS).option("maxRecordsPerFile", file_rows).csv(path, compression=compression)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: JSON Lines (one object per line)."""
    df.write.mode(mode).json(path)


def write_rows(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> None:
    """K6 dispatch; an unknown format is an error."""
    if fmt == "csv":
        write_csv(df, path, mode)
    elif fmt in ("jsonl", "jsonline", "json"):
        write_jsonl(df, path, mode)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"Unsupported output format: {fmt}")


def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Header + inferred types, quoted newlines tolerated. Inference is an
    extra pass over (a sample of) the data: at scale pass `sampling_ratio`
    or, better, an explicit schema (S2)."""
    return (spark.read.options(**CSV_OPTIONS).option("multiLine", "true")
            .option("inferSchema", "true").option("samplingRatio", str(sampling_ratio)).csv(path))


def read_csv_typed(spark: SparkSession, path: str, schema, multiline: bool = True,
                   mode: str = "FAILFAST") -> DataFrame:
    """Explicit schema, no inference pass. Spark converts only the columns
    that a query uses, so FAILFAST sees bad values in those only; count with
    `parsed_count` to see all of them."""
    return (spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
            .option("mode", mode).schema(schema).csv(path))


def read_seed(spark: SparkSession, path: str, column_types: dict[str, str]) -> DataFrame:
    """A seed table from CSV files with a header. Columns named in
    `column_types` get that type as they are written (text keeps its leading
    zeros); the others are inferred. An unknown name is an error."""
    inferred = read_csv_inferred(spark, path).schema
    if unknown := set(column_types) - set(inferred.fieldNames()):
        raise ValueError(f"no such seed column: {sorted(unknown)}")
    ddl = ", ".join(f"`{f.name}` {column_types.get(f.name, f.dataType.simpleString())}" for f in inferred.fields)
    return read_csv_typed(spark, path, ddl)


def parsed_count(df: DataFrame) -> Column:
    """Row count over every column: an aggregate that no pruning can narrow, so
    a bad value in any column fails the read."""
    return F.count_if(F.xxhash64(*[F.col(c) for c in df.columns]) != F.lit(0))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines (`value`) with the file and the block of it they came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"),
                                        F.col("_metadata.file_block_start").alias("block_start"))


def drop_header_and_blank(lines: DataFrame, header: str) -> DataFrame:
    """S3: drop header lines (one per file) and lines of white space only."""
    return lines.filter((F.col("value") != F.lit(header)) & F.col("value").rlike(r"\S"))


def record_start_counts(lines: DataFrame, record_start_pattern: str) -> DataFrame:
    """Physical lines versus lines that start a record, in one pass."""
    return lines.agg(
        F.count(F.lit(1)).alias("physical_lines"),
        F.count_if(F.col("value").rlike(record_start_pattern)).alias("records"),
    )


def parse_delimited(lines: DataFrame, schema: StructType, value_col: str = "value",
                    corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Parse each line with `from_csv` in PERMISSIVE mode; wrong arity or
    a bad value sets `corrupt_col` (the raw line) instead of failing the job."""
    fields = list(schema.fields) + [StructField(corrupt_col, StringType())]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = F.from_csv(F.col(value_col), ddl,
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col,
                         "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return lines.select(parsed.alias("r")).select("r.*")


def split_quarantine(parsed: DataFrame, corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined raw lines)."""
    good = parsed.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = parsed.filter(F.col(corrupt_col).isNotNull()).select(corrupt_col)
    return good, bad


def sniff_dialect(lines: DataFrame, candidates: Sequence[str] = (",", ";", "\t", "|"),
                  sample_fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Per file, the delimiter whose per-line count is most consistent
    (lowest variance, mean > 0), whether a quote char appears, and whether
    the first line looks like a header (no digit in any field while most
    data lines have one). One grouped Spark job; the statistics use a sample
    of the lines, the header is the first line of the file's first block."""
    positioned = lines.withColumn("_pos", F.struct("block_start", F.monotonically_increasing_id()))
    sampled = F.lit(True) if sample_fraction >= 1 else F.rand(seed) < sample_fraction
    per_line = positioned.withColumn("_in", sampled).select(
        "file_path", "value", "_pos", "_in",
        *[(F.size(F.split("value", _regex_escape(d), -1)) - 1).alias(f"d{i}") for i, d in enumerate(candidates)],
    )
    stats = per_line.groupBy("file_path").agg(
        *[F.avg(F.when(F.col("_in"), F.col(f"d{i}"))).alias(f"m{i}") for i in range(len(candidates))],
        *[F.variance(F.when(F.col("_in"), F.col(f"d{i}"))).alias(f"v{i}") for i in range(len(candidates))],
        F.max(F.when(F.col("_in"), F.col("value").contains('"').cast("int"))).alias("has_quote"),
        F.avg(F.when(F.col("_in"), F.col("value").rlike("[0-9]").cast("int"))).alias("digit_share"),
        F.min_by("value", "_pos").alias("first_line"),
    )
    score = F.array(*[
        F.struct(
            F.when(F.col(f"m{i}") > 0, F.coalesce(F.col(f"v{i}"), F.lit(0.0))).otherwise(F.lit(float("inf"))).alias("var"),
            (-F.col(f"m{i}")).alias("neg_mean"),
            F.lit(d).alias("delimiter"),
        )
        for i, d in enumerate(candidates)
    ])
    return stats.select(
        "file_path",
        F.array_min(score)["delimiter"].alias("delimiter"),
        F.when(F.col("has_quote") == 1, F.lit('"')).otherwise(F.lit("")).alias("quote"),
        ((~F.col("first_line").rlike("[0-9]")) & (F.col("digit_share") > 0.5)).alias("has_header"),
    )


def _regex_escape(d: str) -> str:
    return "\\" + d if d in "|.^$*+?()[]{}\\" else d


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])
