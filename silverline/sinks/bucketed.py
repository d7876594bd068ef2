"""Bucketed tables: dedupe and joins on the bucket key without a shuffle.

A table is written once, hashed and sorted by its key into a fixed number of
buckets; whoever groups, ranks or joins on that key later reads bucket by bucket,
and two tables of equally many buckets join bucket with bucket. That pays where a
table is read by its key many times: the shuffle is spent at the write.

What it cannot do is split a bucket. A value that holds far more rows than a
bucket should goes to a table of its own beside the buckets (`hot`): those rows
keep the ordinary, splittable plan. Both parts together are the table; each value
is in one of them, so dedupe and joins by the key are unions of the two.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.catalog import scratch_path, stored

HOT_SHARE = 2.0     # a value with more rows than so many average buckets is hot


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts: `even`, bucketed by `key`, and `hot`, the rows of hot values."""
    key: str
    buckets: int
    even: DataFrame
    hot: DataFrame

    def rows(self) -> DataFrame:
        return self.even.unionByName(self.hot)

    def by_key(self, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """`make`, an operation within the values of the key, on both parts."""
        return make(self.even).unionByName(make(self.hot))


def _saved(df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    spark = df.sparkSession
    name = f"silverline_{uuid.uuid4().hex[:12]}"
    # as many tasks as buckets, each with the rows of one: a bucket is one file
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(spark, label)).saveAsTable(name))
    return spark.table(name)


def write_bucketed(df: DataFrame, key: str, buckets: int, label: str) -> Bucketed:
    """Stores `df` by `key`. Rows are counted by value first (partial sums, so a
    hot value costs nothing); null keys have no bucket to meet in and are hot."""
    spark = df.sparkSession
    source = stored(df, f"{label}-rows")
    sizes = source.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(HOT_SHARE * total / buckets, 1_000)
    # fewer than `buckets` / HOT_SHARE values can be so large
    hot = sizes.where((F.col("n") > most) | F.col(key).isNull()).select(F.col(key).alias("_hot"))
    hot_rows = stored(source.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left_semi"), f"{label}-hot")
    even = source.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left_anti")
    return Bucketed(key, buckets, _saved(even, key, buckets, label), hot_rows)


def join_bucketed(left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """The join of two tables of equal key and number of buckets. The even part of
    `left` meets the even part of `right` without a shuffle; a value that is hot
    on either side meets the other side's rows in an ordinary join."""
    if (left.key, left.buckets) != (right.key, right.buckets) or how != "inner":
        raise ValueError("an inner join of tables bucketed alike")
    return (left.even.join(right.even, left.key)
            .unionByName(left.even.join(right.hot, left.key))
            .unionByName(left.hot.join(right.rows(), left.key)))


def drop_tables(spark: SparkSession) -> None:
    """Removes the names of this module's tables from the session's catalog; their files stay in the scratch folder."""
    for t in spark.catalog.listTables():
        if t.name.startswith("silverline_"):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
