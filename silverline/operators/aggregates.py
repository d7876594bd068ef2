"""Grouped and global aggregations.

All of them are declarative `groupBy().agg()` plans: partial aggregation runs
map-side before the shuffle, so a hot key (one user with a third of all
orders) is pre-combined per task and never sent whole to one reducer.
Shares of a total use a scalar subquery (`DataFrame.scalar()`, evaluated once
and inlined as a literal) instead of an unpartitioned window or a join.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverline.functions import scalars as S


def count_rows(alias: str = "rows") -> Column:
    return F.count(F.lit(1)).alias(alias)


def sum_long(c, alias: str) -> Column:
    return F.sum(S.col(c)).cast("long").alias(alias)


def group_count_sum(df: DataFrame, keys: Sequence, measure: str = "quantity",
                    count_alias: str = "orders", sum_alias: str = "quantity") -> DataFrame:
    """A3/A5: count + sum per group."""
    return df.groupBy(*keys).agg(count_rows(count_alias), sum_long(measure, sum_alias))


def share_of_total(df: DataFrame, key: str, measure: str = "quantity", digits: int = 1,
                   count_alias: str = "orders", share_alias: str = "share_pct") -> DataFrame:
    """Per-group sum and its percentage of the grand total.

    The total is a one-value scalar subquery over the same aggregate (Spark
    reuses the exchange), so no single-partition window and no join."""
    grouped = group_count_sum(df, [key], measure, count_alias, measure)
    total = grouped.select(F.sum(measure)).scalar()
    return grouped.withColumn(share_alias, F.round(F.lit(100) * F.col(measure) / total, digits))


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "occurrences") -> DataFrame:
    """A4: keys seen more than once (HAVING count > 1)."""
    return df.groupBy(*keys).agg(count_rows(alias)).filter(F.col(alias) > 1)


def global_min_max(df: DataFrame, c: str, min_alias: str, max_alias: str) -> DataFrame:
    """A2."""
    return df.agg(F.min(c).alias(min_alias), F.max(c).alias(max_alias))


def per_key_stats(df: DataFrame, key: str, measure: str) -> DataFrame:
    """A18 (aggregateByKey (count, sum) -> average) in one pass."""
    return df.groupBy(key).agg(
        count_rows("order_count"),
        sum_long(measure, "quantity"),
        (F.sum(measure) / F.count(F.lit(1))).alias("avg_quantity"),
    )


def per_key_sum(df: DataFrame, key: str, measure: str, alias: str = "quantity") -> DataFrame:
    """A16 reduceByKey(add): partial + final HashAggregate."""
    return df.groupBy(key).agg(sum_long(measure, alias))


def per_key_sum_without_combine(df: DataFrame, key: str, measure: str, alias: str = "quantity") -> DataFrame:
    """A17 groupByKey + sum: every row crosses the shuffle before it is summed.
    The shuffle is a rebalance on the key, so AQE splits a hot key over several
    tasks; each sums its share and the shares (a few rows per key) are added
    up. No group is ever materialised as a list."""
    return df.select(key, measure).hint("rebalance", F.col(key)).groupBy(key).agg(F.sum(measure).cast("long").alias(alias))


def every_value_groups(df: DataFrame, keys: Sequence[str], c: str, alias: str,
                       materialize: bool = True) -> DataFrame:
    """A11 relational division: groups whose distinct `c` count equals the
    global distinct count (scalar subquery, HAVING).

    Both counts come from one distinct (keys, c) frame, at most keys x values
    rows, built with partial aggregation (a hot key contributes one row per
    value). That frame is stored once (Parquet in the shared checkpoint
    folder), so the expensive input is read once rather than once for the
    subquery and once for the groups."""
    pairs = df.select(*keys, c).distinct()
    if materialize:
        from silverline.catalog import stored

        pairs = stored(pairs, "division-pairs")
    everything = pairs.select(F.count_distinct(c)).scalar()
    return pairs.groupBy(*keys).agg(F.count(c).alias(alias)).filter(F.col(alias) == everything)


def every_value_bits(df: DataFrame, keys: Sequence[str], c: str, alias: str) -> DataFrame:
    """A11 with bit sets in place of stored pairs: values are numbered, a group ors
    one bit a value into words of 64, and has every value if the bits of its words
    add up to their number. The buffer of a group is one long a word, combined
    before the shuffle, and nothing is written. The numbering is one window over
    the distinct values, so it suits dimensions that a report could list."""
    values = df.select(c).where(F.col(c).isNotNull()).distinct()
    numbered = values.select(F.col(c).alias("_value"), (F.row_number().over(Window.orderBy(c)) - 1).alias("_n"))
    marked = df.select(*keys, c).join(numbered, F.col(c) == F.col("_value"))
    words = marked.groupBy(*keys, F.floor(F.col("_n") / 64).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_n % 64 AS INT))")).alias("_bits"))
    held = words.groupBy(*keys).agg(F.sum(F.bit_count("_bits")).cast("long").alias(alias))
    return held.where(F.col(alias) == values.select(F.count(F.lit(1))).scalar())


def conditional_count(df: DataFrame, keys: Sequence[str], predicate: Column, alias: str,
                      count_alias: str = "users") -> DataFrame:
    """Count + count_if per group."""
    return df.groupBy(*keys).agg(count_rows(count_alias), F.count_if(predicate).cast("long").alias(alias))


def pivot_sum(df: DataFrame, row_key, pivot_col: str, values: Sequence[str], measure: str) -> DataFrame:
    """One pass pivot (value list given, so no extra distinct job and no
    `pivotMaxValues` failure)."""
    return df.groupBy(row_key).pivot(pivot_col, list(values)).agg(F.sum(measure).cast("long"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """column_name, distinct_values (exact, nulls apart). Each column goes by itself, so a
    task holds and sends distinct values of one column, not every row once a column; `df`
    is read once a column and should be a stored table."""
    each = [df.select(F.col(f"`{f.name}`").alias("v")).distinct().agg(F.count("v").alias("distinct_values"))
            .select(F.lit(f.name).alias("column_name"), "distinct_values") for f in df.schema.fields]
    return reduce(lambda a, b: a.unionByName(b), each)


def profile_columns(df: DataFrame, exact: bool = False, nulls: bool = False, materialize: bool = True) -> DataFrame:
    """Every column's distinct estimate and null percentage (with `nulls`, the
    number too) in one aggregation pass, then `stack` to one row per column. With
    `exact`, distinct values are counted column by column over the input, which is
    stored once unless `materialize` says that it is a table already."""
    if exact:
        if materialize:
            from silverline.catalog import stored

            df = stored(df, "profiled", "zstd")
        near = profile_columns(df, nulls=True).drop("approx_unique")
        return near.join(distinct_counts(df), "column_name").select(
            "column_name", "column_type", "distinct_values", *(["nulls"] if nulls else []), "null_percentage")
    aggs = []
    for f in df.schema.fields:
        aggs.append(F.approx_count_distinct(f.name).alias(f"d_{f.name}"))
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"n_{f.name}"))
    aggs.append(count_rows("_total"))
    wide = df.agg(*aggs)
    n = len(df.schema.fields)
    parts = ", ".join(
        f"'{f.name}', '{f.dataType.simpleString()}', CAST(`d_{f.name}` AS BIGINT), CAST(`n_{f.name}` AS BIGINT)"
        for f in df.schema.fields
    )
    stacked = wide.selectExpr(
        f"stack({n}, {parts}) AS (column_name, column_type, distinct_values, nulls)", "_total"
    )
    null_pct = F.when(F.col("_total") == 0, F.lit(0)).otherwise(
        F.round(F.col("nulls").cast("decimal(38,6)") * 100 / F.col("_total"), 2)
    ).cast("decimal(9,2)")
    return stacked.select(
        "column_name", "column_type",
        F.col("distinct_values").alias("approx_unique"), *(["nulls"] if nulls else []),
        null_pct.alias("null_percentage"),
    )


# ---------------------------------------------------------------- profiles that add up

def profile_parts(df: DataFrame, batch: str, lg_size: int = 12) -> DataFrame:
    """A15 in parts: one row per column of a batch with its rows, its nulls and a
    HyperLogLog sketch of its values (2^lg_size registers, standard error about
    1.04 / sqrt of that), in one pass. Parts of batches are merged by
    `profile_merged`; the batches themselves are not read again."""
    def sketch(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        return F.hll_sketch_agg(c if kind in ("int", "bigint", "string", "binary") else c.cast("string"), F.lit(lg_size))

    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wide = df.agg(count_rows("_rows"), *[F.struct(F.count_if(F.col(f"`{n}`").isNull()).alias("nulls"), sketch(n, k).alias("sketch")).alias(f"c{i}")
                                         for i, (n, k) in enumerate(kinds)])
    return wide.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("column_type"), F.col(f"c{i}.nulls").alias("nulls"), F.col(f"c{i}.sketch").alias("sketch"))
        for i, (n, k) in enumerate(kinds)])).alias("p")).select(
        F.lit(batch).alias("batch"), "p.column_name", "p.column_type", F.col("_rows").alias("rows"), "p.nulls", "p.sketch")


def profile_merged(parts: DataFrame) -> DataFrame:
    """The profile of all batches together: rows, nulls and null percentage exact,
    distinct values estimated from the union of the sketches."""
    merged = parts.groupBy("column_name", "column_type").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_unique"))
    share = F.when(F.col("rows") == 0, F.lit(0)).otherwise(F.round(F.col("nulls").cast("decimal(38,6)") * 100 / F.col("rows"), 2))
    return merged.withColumn("null_percentage", share.cast("decimal(9,2)"))
