"""Derived views over the driver tables (the shapes of the studied work).

The driver ships TPC-H-like tables; the studied pipeline works on a parent
table (users) and an event table (orders). These functions derive that shape
with column expressions only, so every downstream query scans the real tables
and its work grows with them:

* ``bronze_users``  from ``customer`` (padded/mixed-case text, two-line
  addresses incl. military ones, NULL and too-late birthdates)
* ``bronze_orders`` from ``lineitem ⋈ orders ⋈ part`` (natural duplicates of
  ``l_orderkey*10 + l_linenumber`` and padded products)
* ``sales``         from ``events`` (orders with a time of day)
* ``zip_states``    from ``customer`` (reference ZIP/state pairs: 3/5 right,
  1/5 wrong state, 1/5 absent)
* ``stg_orders`` / ``stg_users``: the silver models of `plans.silver`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import Tables, stored
from silverline.functions.reference import STATE_CODES
from silverline.plans import silver

_CODES = ",".join(STATE_CODES)


def _state_code(index: Column) -> Column:
    """1-based position in the state code list."""
    return F.split_part(F.lit(_CODES), F.lit(","), index)


def _zip_text(key: Column) -> Column:
    return F.lpad((key * 37 % 100000).cast("string"), 5, "0")


def bronze_users(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    military = k % 62 >= 59
    line1_and_city = F.when(
        military, F.concat(F.lit("Unit "), k.cast("string"), F.lit(" Box 1\nDPO "))
    ).otherwise(F.concat(k.cast("string"), F.lit(" Main St\nLake "), F.col("c_mktsegment"), F.lit(", ")))
    address = F.concat(line1_and_city, _state_code((k % 62).cast("int") + 1), F.lit(" "), _zip_text(k))
    return customer.select(
        k.alias("uuid"),
        F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
        .otherwise(F.col("c_name")).alias("username"),
        F.col("c_name").alias("name"),
        F.when(k % 2 == 0, F.lit(" f")).otherwise(F.lit("M")).alias("sex"),
        address.alias("address"),
        F.concat(F.lit(" "), F.upper("c_name"), F.lit("@Example.com ")).alias("mail"),
        F.when(k % 97 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(F.lit("1990-01-01").cast("date"), (k * 7 % 4000).cast("int")))
        .alias("birthdate"),
    )


def bronze_orders(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Line items as orders. Two equi-joins on the big keys; Catalyst prunes
    every unused column at the scan and AQE picks broadcast vs. shuffle from
    runtime sizes (part is ~1/30 of lineitem)."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_quantity", "l_extendedprice", "l_shipdate")
    o = orders.select(F.col("o_orderkey"), F.col("o_custkey"))
    p = part.select("p_partkey", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("uuid"),
        F.col("o_custkey").alias("user_uuid"),
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.concat(F.lit(" "), F.col("p_type")).alias("product"),
        "l_partkey", "l_suppkey", "l_extendedprice",
    )


def sales(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("order_id"),
        "user_id",
        F.col("ts").alias("ordered_at"),
        (F.floor("value").cast("int") + 1).alias("quantity"),
        F.col("event_type").alias("product"),
    )


def zip_states(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    shift = F.when(k % 5 == 3, F.lit(1)).otherwise(F.lit(0))
    return customer.filter(k % 5 != 4).select(
        _zip_text(k).alias("zip_code"),
        _state_code(((k + shift) % 62).cast("int") + 1).alias("state"),
    )


def states(spark: SparkSession) -> DataFrame:
    """S10 seed: the 62 state codes, string typed. Fixed size -> safe to broadcast."""
    return spark.createDataFrame([(c,) for c in STATE_CODES], "code string")


class Views:
    """All derived views of one driver directory, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)

    @cached_property
    def bronze_users(self) -> DataFrame:
        return bronze_users(self.t.customer)

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return bronze_orders(self.t.lineitem, self.t.orders, self.t.part)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return silver.stg_orders(self.bronze_orders)

    @cached_property
    def stg_users(self) -> DataFrame:
        return silver.stg_users(self.bronze_users, self.stg_orders)

    @cached_property
    def dirty_orders(self) -> DataFrame:
        """Silver orders with planted faults: unknown users, missing and zero quantities."""
        k = F.col("order_id")
        return self.stg_orders.select(
            "order_id", F.when(k % 17 == 0, -F.col("user_id")).otherwise(F.col("user_id")).alias("user_id"), "ordered_at",
            F.when(k % 19 == 0, F.lit(None)).when(k % 23 == 0, F.lit(0)).otherwise(F.col("quantity")).cast("int").alias("quantity"),
            "product")

    @cached_property
    def dirty_users(self) -> DataFrame:
        """Silver users with planted faults: names not normalised, uncleaned
        birthdates, wrong flags."""
        k = F.col("user_id")
        return self.stg_users.select(
            "user_id", "username",
            F.when(k % 13 == 0, F.upper("username")).otherwise(F.col("username_normalized")).alias("username_normalized"),
            "birthdate_original",
            F.when(k % 7 == 0, F.col("birthdate_original")).otherwise(F.col("birthdate")).alias("birthdate"),
            F.when(k % 11 == 0, ~F.col("birthdate_is_valid")).otherwise(F.col("birthdate_is_valid")).alias("birthdate_is_valid"))

    @cached_property
    def sales(self) -> DataFrame:
        return sales(self.t.events)

    @cached_property
    def zip_states(self) -> DataFrame:
        return zip_states(self.t.customer)

    @cached_property
    def states(self) -> DataFrame:
        return states(self.spark)

    def checkpointed(self) -> "Views":
        """Same views with the two silver models computed once and stored
        (Parquet under the session's checkpoint folder), for consumers that
        read them many times, like the check report: the bronze joins and the
        dedupe then run once instead of once per branch, and the stored rows
        survive executor loss."""
        out = Views(self.spark, self.sf_dir)
        orders = stored(self.stg_orders, "stg-orders")
        out.__dict__["stg_orders"] = orders
        out.__dict__["stg_users"] = stored(silver.stg_users(out.bronze_users, orders), "stg-users")
        return out
