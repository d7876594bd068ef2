"""Window reports.

Rule: a window without PARTITION BY moves every row to one task, so it is only
applied to a frame already aggregated to a bounded calendar grain (days,
months, hours). Partitioned windows run on per-group aggregates.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from silverline.operators.aggregates import sum_long


def daily_totals(df: DataFrame, ts: str, measure: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(sum_long(measure, measure))


def running_total(daily: DataFrame, order_col: str, measure: str, alias: str = "cumulative") -> DataFrame:
    """ROWS UNBOUNDED PRECEDING .. CURRENT ROW over the calendar grain."""
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn(alias, F.sum(measure).over(w).cast("long"))


def moving_average(daily: DataFrame, order_col: str, measure: str, rows: int = 7,
                   digits: int = 1, alias: str = "avg_7d") -> DataFrame:
    """ROWS (rows-1) PRECEDING .. CURRENT ROW (gaps count as rows)."""
    w = Window.orderBy(order_col).rowsBetween(-(rows - 1), Window.currentRow)
    return daily.withColumn(alias, F.round(F.avg(measure).over(w), digits))


def top_per_partition(agg: DataFrame, partition: Sequence[str], measure: str) -> DataFrame:
    """QUALIFY rank() = 1 per partition, ties kept (Spark has no QUALIFY;
    rank in a second select, then filter; Catalyst adds WindowGroupLimit)."""
    w = Window.partitionBy(*partition).orderBy(F.col(measure).desc())
    return agg.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def top_overall(agg: DataFrame, measure: str) -> DataFrame:
    """QUALIFY rank() OVER (ORDER BY m DESC) = 1 without a one-partition
    window: keep rows equal to the scalar maximum."""
    best = agg.select(F.max(measure)).scalar()
    return agg.filter(F.col(measure) == best)


def change_vs_previous(agg: DataFrame, partition: Sequence[str], order_col: str, measure: str,
                       digits: int = 2) -> DataFrame:
    """Lag per partition and percentage change; previous 0 -> NULL."""
    w = Window.partitionBy(*partition).orderBy(order_col)
    prev = F.lag(measure).over(w)
    return (
        agg.withColumn("previous_quantity", prev)
        .withColumn(
            "mom_pct",
            F.round(
                F.lit(100.0) * (F.col(measure) - F.col("previous_quantity"))
                / F.nullif(F.col("previous_quantity"), F.lit(0)),
                digits,
            ),
        )
    )
