"""Checks counted by the write, and stored failures by run."""

import json

import pytest
from pyspark.sql import functions as F

from silverline.operators import quality as Q
from silverline.plans import silver
from silverline.plans.q_quality import contract
from silverline.plans.views import Views
from tests.conftest import SF_SMALL

ROWS = [(1, 5, "a"), (2, None, "b"), (3, -1, None), (4, -2, "zz"), (5, 0, "a")]


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(ROWS, "id int, quantity int, product string")


def rules_on(df):
    return [Q.not_null(df, "quantity", "id"), Q.accepted_values(df, "product", ["a", "b"], "id"),
            Q.expression(df, "positive", F.col("quantity") <= 0, "id", columns=("quantity",)),
            Q.unique(df, "product"), Q.expression(df, "any", F.col("id") > 4, "id")]


def counts(report):
    return {r["rule"]: (r["severity"], r["failures"], r["status"]) for r in report.collect()}


def test_observed_counts_equal_a_scan(spark, orders, tmp_path):
    wide = orders.withColumn("other", F.lit(1))         # a joined frame has more columns
    rules = rules_on(wide)
    riding = Q.observable(rules, orders)
    assert [r.name for r in riding] == ["not_null_quantity", "accepted_values_product", "positive"]
    table, counted = Q.write_observed(orders.repartition(3), str(tmp_path / "t"), riding)
    assert counted == {"not_null_quantity": 1, "accepted_values_product": 1, "positive": 3}
    assert sorted(map(tuple, table.collect()), key=repr) == sorted(ROWS, key=repr)
    again = [r for r in rules_on(table)]
    assert counts(Q.report_of(spark, again, counted)) == counts(Q.run_checks(again))


def test_observed_write_of_no_rows(spark, orders, tmp_path):
    for name, empty in (("a", orders.limit(0)), ("b", orders.where("id > 99")), ("c", spark.createDataFrame([], orders.schema))):
        table, counted = Q.write_observed(empty, str(tmp_path / name), Q.observable(rules_on(orders), orders))
        assert table.count() == 0 and set(counted.values()) == {0}


def test_the_contract_rides_on_both_writes(spark):
    v = Views(spark, SF_SMALL)
    rules = contract(v)
    on_orders, on_users = Q.observable(rules, v.stg_orders), Q.observable(rules, v.stg_users)
    assert len(on_orders) == 7 and len(on_users) == 8
    assert not {r.name for r in on_orders} & {r.name for r in on_users}
    assert "assert_quantity_positive" in {r.name for r in on_orders} and "not_null_stg_users_state" in {r.name for r in on_users}
    rest = [r for r in contract(v) if r.name not in {x.name for x in on_orders + on_users}]
    full, fewer = (Q.run_checks(x)._jdf.queryExecution().optimizedPlan().toString() for x in (rules, rest))
    assert fewer.count("count(if") < full.count("count(if") or fewer.count("count_if") <= full.count("count_if")


def test_a_repeated_run_replaces_its_own_partitions(spark, orders, tmp_path):
    path = str(tmp_path / "audit")
    Q.store_failures_of_run(rules_on(orders), path, "1")
    Q.store_failures_of_run(rules_on(orders), path, "2")
    before = sorted(map(tuple, Q.read_failures(spark, path).where("run = '1'").collect()), key=repr)
    fixed = orders.withColumn("quantity", F.lit(7))
    Q.store_failures_of_run(rules_on(fixed)[:3], path, "2")       # the unique and the last rule are not run again
    got = {(r["rule"], r["run"]): r["failures"] for r in Q.failures_by_run(spark, path).collect()}
    assert got == {("not_null_quantity", "1"): 1, ("accepted_values_product", "1"): 1, ("positive", "1"): 3, ("unique_product", "1"): 1, ("any", "1"): 1,
                   ("not_null_quantity", "2"): 0, ("accepted_values_product", "2"): 1, ("positive", "2"): 0, ("unique_product", "2"): 1, ("any", "2"): 1}
    assert sorted(map(tuple, Q.read_failures(spark, path).where("run = '1'").collect()), key=repr) == before
    row = Q.read_failures(spark, path).where("rule = 'not_null_quantity' AND run = '1'").first()
    assert row["record_key"] == "2" and json.loads(row["record"]) == {"id": 2, "quantity": None, "product": "b"}
    assert json.loads(Q.read_failures(spark, path).where("rule = 'unique_product' AND run = '1'").first()["record"]) == {"product": "a", "n_records": 2}


def test_reading_one_run_prunes_the_others(spark, orders, tmp_path):
    path = str(tmp_path / "audit")
    Q.store_failures_of_run(rules_on(orders), path, "1")
    Q.store_failures_of_run(rules_on(orders), path, "2")
    plan = Q.read_failures(spark, path).where("run = '2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan


def test_users_model_stored_by_the_observed_build(spark, tmp_path):
    from silverline.plans.build import build_silver_observed

    out = str(tmp_path / "lake")
    report = build_silver_observed(spark, SF_SMALL, out)
    assert report.count() == 28
    users = spark.read.parquet(f"{out}/silver/users")
    assert users.exceptAll(silver.stg_users(Views(spark, SF_SMALL).bronze_users, Views(spark, SF_SMALL).stg_orders)).count() == 0
