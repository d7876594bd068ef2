"""Registered UDF-variant queries (2.14) and synthetic generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.catalog import stored
from silverline.functions import udfs as U
from silverline.functions.reference import UUID_PATTERN
from silverline.operators import reconcile as R
from silverline.plans.registry import query
from silverline.plans.views import Views
from silverline.sources import generate as G

_NATIVE = "regexp_extract(address, '([A-Z]{2}) ([0-9]{5})$', 2)"
_TAIL = "regexp_extract(address, '([0-9]{5})$', 1)"


@query("zip_native", oracle=f"SELECT uuid, {_NATIVE} AS zip_code FROM bronze_users", views=("bronze_users",))
def q_zip_native(spark, sf_dir):
    """F1."""
    return Views(spark, sf_dir).bronze_users.select("uuid", U.zip_native("address").alias("zip_code"))


@query("zip_python_udf", oracle=f"SELECT uuid, {_NATIVE} AS zip_code FROM bronze_users", views=("bronze_users",))
def q_zip_python_udf(spark, sf_dir):
    """row-at-a-time Python UDF (the slow path, for comparison)."""
    return Views(spark, sf_dir).bronze_users.select("uuid", U.zip_python_udf("address").alias("zip_code"))


@query("zip_pandas_udf", oracle=f"SELECT uuid, {_TAIL} AS zip_code FROM bronze_users", views=("bronze_users",))
def q_zip_pandas_udf(spark, sf_dir):
    """Arrow-batched pandas UDF."""
    return Views(spark, sf_dir).bronze_users.select("uuid", U.zip_pandas_udf("address").alias("zip_code"))


@query("zip_variants_equal", oracle=f"""
SELECT 'native' AS variant, CAST(sum(length({_NATIVE})) AS BIGINT) AS total_length, CAST(0 AS BIGINT) AS different_rows
FROM bronze_users
UNION ALL SELECT 'python_udf', CAST(sum(length({_NATIVE})) AS BIGINT), CAST(0 AS BIGINT) FROM bronze_users
UNION ALL SELECT 'pandas_udf', CAST(sum(length({_TAIL})) AS BIGINT),
       2 * count(*) FILTER (WHERE {_NATIVE} IS DISTINCT FROM {_TAIL}) FROM bronze_users""", views=("bronze_users",))
def q_zip_variants_equal(spark, sf_dir):
    """every variant against the native one (EXCEPT ALL both ways on
    (key, zip)), and a forced evaluation (sum of lengths: a bare count could
    skip the column)."""
    users = Views(spark, sf_dir).bronze_users
    variants = {
        "native": U.zip_native("address"),
        "python_udf": U.zip_python_udf("address"),
        "pandas_udf": U.zip_pandas_udf("address"),
    }
    frames = {k: users.select("uuid", c.alias("zip_code")) for k, c in variants.items()}
    out = None
    for name, frame in frames.items():
        diff = R.diff_rows(frames["native"], frame).select(F.count(F.lit(1))).scalar()
        row = frame.agg(F.lit(name).alias("variant"), F.sum(F.length("zip_code")).cast("long").alias("total_length"),
                        diff.alias("different_rows"))
        out = row if out is None else out.unionByName(row)
    return out


@query("generate_users", oracle="""
SELECT count(*) AS users, count(*) AS distinct_ids, true AS well_formed FROM customer""")
def q_generate_users(spark, sf_dir):
    """One seeded synthetic user per customer key: ids distinct and
    UUID-shaped, ZIP of five digits, birthdates within their range."""
    users = G.generate_users(Views(spark, sf_dir).t.customer.select("c_custkey"), "c_custkey", seed=42)
    fine = (F.col("uuid").rlike(f"^{UUID_PATTERN}$") & F.col("address").rlike("[A-Z]{2} [0-9]{5}$") & F.col("sex").isin("F", "M")
            & F.col("birthdate").between("1930-01-01", "2012-02-20"))
    return users.agg(F.count(F.lit(1)).alias("users"), F.count_distinct("uuid").alias("distinct_ids"), F.every(fine).alias("well_formed"))


@query("generate_orders", oracle="""
SELECT 0 AS orphans, true AS ids_distinct, true AS slots_consecutive, true AS at_most_hundred, true AS well_formed FROM region LIMIT 1""")
def q_generate_orders(spark, sf_dir):
    """Seeded orders for those users, one per global hour slot: every
    order's user exists, ids are distinct, slots run from 0 without a gap."""
    users = G.generate_users(Views(spark, sf_dir).t.customer.select("c_custkey"), "c_custkey", seed=42)
    orders = stored(G.generate_orders(users, count_min=0, count_max=100, seed=42), "generated-orders")
    n = F.count(F.lit(1))
    orphans = orders.join(users.select(F.col("uuid").alias("user_uuid")), "user_uuid", "left_anti").select(n.cast("int")).scalar()
    most = orders.groupBy("user_uuid").agg(n.alias("n")).select(F.max("n")).scalar()
    return orders.agg(
        orphans.alias("orphans"), (F.count_distinct("uuid") == n).alias("ids_distinct"),
        ((F.min("hour_slot") == 0) & (F.max("hour_slot") == n - 1) & (F.count_distinct("hour_slot") == n)).alias("slots_consecutive"),
        (most <= 100).alias("at_most_hundred"), F.every(F.col("quantity").between(1, 5)).alias("well_formed"))
