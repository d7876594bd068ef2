"""Row-level reconciliation of two outputs.

`diff_rows` is the multiset difference in both directions (EXCEPT ALL), so
duplicates count: two frames are identical iff it is empty. Both directions
come from one union + aggregate over all columns (partial aggregation
first), so each input is read once and repeated rows are counted map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def align(left: DataFrame, right: DataFrame) -> DataFrame:
    """Select `right`'s columns in `left`'s order, cast to `left`'s types."""
    types = {f.name: f.dataType for f in left.schema.fields}
    return right.select(*[F.col(c).cast(types[c]).alias(c) for c in left.columns])


def _side_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per distinct row: how many copies each side has, in ONE aggregation
    over the union of both inputs (NULLs group together, as in EXCEPT ALL).
    Partial aggregation runs before the shuffle, so heavily repeated rows
    are counted map-side."""
    r = align(left, right)
    tagged = (left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
              .unionByName(r.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))))
    counts = tagged.groupBy(*left.columns).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    return counts.filter(F.col("_nl") != F.col("_nr"))


# Copies of one differing row are re-expanded in chunks of this size, so no
# task ever builds an array longer than this (a row repeated a billion times
# becomes ~250k chunk rows, each expanded lazily).
EXPAND_CHUNK = 4096


def diff_rows(left: DataFrame, right: DataFrame, side_col: str = "side") -> DataFrame:
    """Multiset difference in both directions (left EXCEPT ALL right, and the
    reverse), labelled by side. Each input is read once (plain `exceptAll`
    twice would read both inputs twice)."""
    d = _side_counts(left, right)
    surplus = F.abs(F.col("_nl") - F.col("_nr")).cast("long")
    side = F.when(F.col("_nl") > F.col("_nr"), F.lit("left_only")).otherwise(F.lit("right_only"))
    chunk = F.lit(EXPAND_CHUNK).cast("long")
    n_chunks = F.floor((surplus + chunk - 1) / chunk).cast("long")
    chunks = d.select(*left.columns, side.alias(side_col), surplus.alias("_k"),
                      F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("_c"))
    in_chunk = F.least(chunk, F.col("_k") - F.col("_c") * chunk)
    return chunks.select(*left.columns, side_col,
                         F.explode(F.sequence(F.lit(1).cast("long"), in_chunk)).alias("_copy")).drop("_copy")


def different_row_count(left: DataFrame, right: DataFrame, label: str, label_col: str = "model") -> DataFrame:
    """One row (label, different_rows): rows only on one side, with copies."""
    d = _side_counts(left, right)
    return d.agg(F.lit(label).alias(label_col),
                 F.coalesce(F.sum(F.abs(F.col("_nl") - F.col("_nr"))), F.lit(0)).cast("long").alias("different_rows"))


def assert_identical(left: DataFrame, right: DataFrame, label: str) -> None:
    """Raise if the frames differ as multisets (looks at one differing row)."""
    bad = _side_counts(left, right).take(1)
    if bad:
        side = "left" if bad[0]["_nl"] > bad[0]["_nr"] else "right"
        raise AssertionError(f"{label}: {side}-only rows")


def summary(left: DataFrame, right: DataFrame, measure: str, left_label="left", right_label="right") -> DataFrame:
    """M4: per side, row count and sum of `measure` (UNION ALL of labelled
    one-row aggregates)."""
    def one(df, label):
        return df.agg(F.lit(label).alias("engine"), F.count(F.lit(1)).alias("rows"),
                      F.sum(measure).cast("long").alias(f"sum_{measure}"))

    return one(left, left_label).unionByName(one(right, right_label))


def schema_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """M4: columns whose presence or type differs (schema metadata only:
    bounded by the column count, never by data)."""
    lt = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    rt = {f.name: f.dataType.simpleString() for f in right.schema.fields}
    rows = [(c, lt.get(c), rt.get(c)) for c in sorted(set(lt) | set(rt)) if lt.get(c) != rt.get(c)]
    return spark.createDataFrame(rows, "column_name string, left_type string, right_type string")
