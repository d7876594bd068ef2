"""Physical-plan properties the design relies on (pushdown, pruning, partial
aggregation, top-k, broadcast of fixed-size seeds) and metamorphic checks."""

import pytest
from pyspark.sql import functions as F

from silverline.catalog import Tables
from silverline.operators.dedupe import latest_per_key
from silverline.plans.registry import all_queries
from silverline.plans.silver import ORDER_TIES
from silverline.plans.views import Views
from silverline.sources import generate as G
from tests.conftest import SF_SMALL

Q = all_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_filter_pushed_to_scan(spark):
    p = plan(Q["date_filter_empty"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_column_pruning(spark):
    p = plan(Q["parquet_scan"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in p


def test_partition_filter(spark, tmp_path):
    from silverline.sinks import files as K

    path = str(tmp_path / "by_product")
    K.write_partitioned(Views(spark, SF_SMALL).stg_orders, path, ["product"])
    p = plan(spark.read.parquet(path).filter(F.col("product") == "large"))
    assert "PartitionFilters: [isnotnull(product" in p and "(product#" in p


def test_partial_aggregation(spark):
    p = Q["quantity_per_user"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in p


def test_scan_plan_does_not_depend_on_the_data_size(spark):
    import re

    seen = set()
    for sf in (SF_SMALL, SF_SMALL.replace("0.001", "0.1")):
        p = Q["date_filter_count"](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in p and "hashpartitioning" not in p
        seen.add(re.sub(r"Location: [^,]*,|#\d+L?|\[plan_id=\d+\]", "", p))
    assert len(seen) == 1


def test_dedupe_sorts_once_on_each_side_of_one_exchange(spark):
    b = Views(spark, SF_SMALL).bronze_orders
    stored = spark.createDataFrame(b.limit(0).collect(), b.schema)
    p = latest_per_key(stored, ["uuid"], ORDER_TIES)._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1 and p.count("Sort [") == 2 and "WindowGroupLimit" in p


def test_user_sized_joins(spark):
    p = Q["top_customers"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joined = p[p.index("Join Inner"):]
    assert "Aggregate [user_id" in joined


def test_top_k_is_take_ordered(spark):
    p = plan(Q["top_customers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_seed_broadcast(spark):
    df = Q["reference_states"](spark, SF_SMALL)
    df.collect()
    assert "BroadcastHashJoin" in plan(df) or "BroadcastExchange" in plan(df)


def test_dedupe_idempotent_and_partition_independent(spark):
    b = Views(spark, SF_SMALL).bronze_orders
    once = latest_per_key(b, ["uuid"], ORDER_TIES)
    twice = latest_per_key(once, ["uuid"], ORDER_TIES)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    other = latest_per_key(b.repartition(5, "l_partkey"), ["uuid"], ORDER_TIES, method="window")
    assert once.exceptAll(other).count() == 0 and other.exceptAll(once).count() == 0


@pytest.mark.parametrize("n", [1, 3])
def test_report_independent_of_partitioning(spark, n):
    from silverline.operators import aggregates as A

    o = Views(spark, SF_SMALL).stg_orders
    a = A.group_count_sum(o, ["product"])
    b = A.group_count_sum(o.repartition(n), ["product"])
    assert a.exceptAll(b).count() == 0


def test_generated_orders_invariants(spark):
    keys = Tables(spark, SF_SMALL).customer.select("c_custkey")
    users = G.generate_users(keys, "c_custkey", seed=7)
    orders = G.generate_orders(users, count_min=1, count_max=5, seed=7)
    stats = orders.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hour_slot").alias("slots"),
                       F.min("hour_slot").alias("lo"), F.max("hour_slot").alias("hi"),
                       F.min("quantity").alias("qmin"), F.max("quantity").alias("qmax")).collect()[0]
    assert stats.n == stats.slots == stats.hi - stats.lo + 1 and stats.lo == 0
    assert 1 <= stats.qmin and stats.qmax <= 5
    assert orders.join(users, orders.user_uuid == users.uuid, "left_anti").count() == 0
    per_user = orders.groupBy("user_uuid").count().agg(F.min("count"), F.max("count")).collect()[0]
    assert 1 <= per_user[0] and per_user[1] <= 5
    again = G.generate_orders(G.generate_users(keys, "c_custkey", seed=7), count_min=1, count_max=5, seed=7)
    assert orders.exceptAll(again).count() == 0
    assert users.select("uuid").distinct().count() == keys.count()


def test_every_column_of_the_orders_is_profiled(spark):
    from silverline.plans.registry import all_queries
    from silverline.plans.views import Views

    orders = Views(spark, "/root/testdata/sf0.001").bronze_orders
    got = {r["column_name"]: r for r in all_queries()["profile_all_columns"](spark, "/root/testdata/sf0.001").collect()}
    assert {n: r["column_type"] for n, r in got.items()} == dict(orders.dtypes)
    assert all(r["close"] and r["nulls"] == 0 and r["null_percentage"] == 0 for r in got.values())
