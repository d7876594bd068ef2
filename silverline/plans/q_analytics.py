"""Registered analytics queries (2.3-2.9, 2.12 M1/M2/M5) with DuckDB oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from silverline.catalog import Tables, stored
from silverline.functions import scalars as S
from silverline.functions.reference import AGE_REFERENCE_DATE, DRIVER_PRODUCTS, MILITARY_STATES, UUID_PATTERN
from silverline.operators import aggregates as A
from silverline.operators import windows as W
from silverline.operators.dedupe import latest_per_key
from silverline.plans import silver
from silverline.plans.registry import query
from silverline.plans.views import Views

# ---------------------------------------------------------------- models M1/M2


@query("stg_orders", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_stg_orders(spark, sf_dir):
    return Views(spark, sf_dir).stg_orders


@query("stg_users", oracle="SELECT * FROM stg_users", views=("stg_users",))
def q_stg_users(spark, sf_dir):
    return Views(spark, sf_dir).stg_users


@query("latest_by_reduce", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_latest_by_reduce(spark, sf_dir):
    """Latest record per key by a reduce (max_by over a rank struct),
    the other physical form than `stg_orders` uses."""
    return silver.stg_orders(Views(spark, sf_dir).bronze_orders, method="aggregate")


@query("dedupe_latest", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_dedupe_latest(spark, sf_dir):
    """row_number() = 1 per key, newest first, explicit tie columns."""
    return silver.stg_orders(Views(spark, sf_dir).bronze_orders, method="window")


@query("typed_orders", oracle="""
SELECT uuid AS order_id, user_uuid AS user_id, date AS ordered_at, quantity,
       lower(trim(product)) AS product FROM bronze_orders""", views=("bronze_orders",))
def q_typed_orders(spark, sf_dir):
    return silver.typed_orders(Views(spark, sf_dir).bronze_orders)


@query("typed_users", oracle="""
SELECT uuid AS user_id, trim(username) AS username, trim(name) AS name, upper(trim(sex)) AS sex,
       lower(trim(mail)) AS email, birthdate AS birthdate_original,
       split_part(address, chr(10), 1) AS street, split_part(address, chr(10), 2) AS address_line_2
FROM bronze_users""", views=("bronze_users",))
def q_typed_users(spark, sf_dir):
    return silver.typed_users(Views(spark, sf_dir).bronze_users).withColumnRenamed("l2", "address_line_2")


# ---------------------------------------------------------------- aggregations


@query("sales_by_product", oracle="""
SELECT product, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity
FROM stg_orders GROUP BY product""", views=("stg_orders",))
def q_sales_by_product(spark, sf_dir):
    return A.group_count_sum(Views(spark, sf_dir).stg_orders, ["product"])


@query("product_share_pct", oracle="""
SELECT product, len(sold) AS orders, CAST(list_sum(sold) AS BIGINT) AS quantity,
       round(100 * list_sum(sold) / (SELECT sum(quantity) FROM stg_orders), 1) AS share_pct
FROM (SELECT product, list(quantity) AS sold FROM stg_orders GROUP BY product)""", views=("stg_orders",))
def q_product_share_pct(spark, sf_dir):
    return A.share_of_total(Views(spark, sf_dir).stg_orders, "product", "quantity", digits=1)


@query("table_counts", oracle="""
SELECT (SELECT count(*) FROM bronze_users) AS users, (SELECT count(*) FROM bronze_orders) AS orders""",
       views=("bronze_users", "bronze_orders"))
def q_table_counts(spark, sf_dir):
    v = Views(spark, sf_dir)
    users = v.bronze_users.select(F.count(F.lit(1))).scalar()
    return v.bronze_orders.agg(users.alias("users"), F.count(F.lit(1)).alias("orders"))


@query("first_last_order", oracle="""
SELECT min(date) AS first_order, max(date) AS last_order FROM bronze_orders""", views=("bronze_orders",))
def q_first_last_order(spark, sf_dir):
    return A.global_min_max(Views(spark, sf_dir).bronze_orders, "date", "first_order", "last_order")


@query("duplicate_keys", oracle="""
SELECT uuid, count(*) AS occurrences FROM bronze_orders GROUP BY uuid HAVING count(*) > 1""",
       views=("bronze_orders",))
def q_duplicate_keys(spark, sf_dir):
    return A.duplicate_keys(Views(spark, sf_dir).bronze_orders, ["uuid"])


@query("monthly_sales", oracle="""
SELECT CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS month, count(*) AS orders,
       CAST(sum(quantity) AS BIGINT) AS quantity
FROM stg_orders GROUP BY 1""", views=("stg_orders",))
def q_monthly_sales(spark, sf_dir):
    return A.group_count_sum(Views(spark, sf_dir).stg_orders, [S.month_start("ordered_at").alias("month")])


@query("top_customers", oracle="""
SELECT username, name, CAST(sum(n) AS BIGINT) AS orders, CAST(sum(q) AS BIGINT) AS quantity
FROM (SELECT user_id, count(*) AS n, sum(quantity) AS q FROM stg_orders GROUP BY user_id) JOIN stg_users USING (user_id)
GROUP BY username, name ORDER BY quantity DESC, username LIMIT 5""", views=("stg_users",))
def q_top_customers(spark, sf_dir):
    """A6 + O2: orders are summed per user first, so the join is user-sized;
    orderBy + limit plans as TakeOrderedAndProject, never a global sort."""
    v = Views(spark, sf_dir)
    per_user = A.group_count_sum(v.stg_orders, ["user_id"])
    j = v.stg_users.select("user_id", "username", "name").join(per_user, "user_id")
    agg = j.groupBy("username", "name").agg(A.sum_long("orders", "orders"), A.sum_long("quantity", "quantity"))
    return agg.orderBy(F.col("quantity").desc(), F.col("username").asc()).limit(5)


@query("age_group_stats", oracle=f"""
SELECT CAST((year(DATE '{AGE_REFERENCE_DATE}') - year(u.birthdate_original)) // 20 * 20 AS INTEGER) AS age_group,
       count(DISTINCT u.user_id) AS users, count(*) AS orders, round(avg(o.quantity), 2) AS avg_quantity
FROM stg_orders o JOIN stg_users u ON o.user_id = u.user_id GROUP BY 1""", views=("stg_users",))
def q_age_group_stats(spark, sf_dir):
    """A10: per-user counts and sums joined to the users, then grouped by age."""
    v = Views(spark, sf_dir)
    per_user = A.group_count_sum(v.stg_orders, ["user_id"])
    j = v.stg_users.select("user_id", "birthdate_original").join(per_user, "user_id")
    return j.groupBy(S.age_group("birthdate_original", AGE_REFERENCE_DATE).alias("age_group")).agg(
        F.count(F.lit(1)).alias("users"),
        A.sum_long("orders", "orders"),
        F.round(F.sum("quantity") / F.sum("orders"), 2).alias("avg_quantity"),
    )


@query("scalar_ratio", oracle="""
SELECT sum(an_order) / sum(a_user) AS avg_orders_per_user, sum(units) / sum(an_order) AS avg_quantity_per_order
FROM (SELECT 1 AS an_order, 0 AS a_user, quantity AS units FROM stg_orders UNION ALL SELECT 0, 1, 0 FROM stg_users)""", views=("stg_users",))
def q_scalar_ratio(spark, sf_dir):
    """Ratio of two scalar counts (uncorrelated scalar subqueries)."""
    v = Views(spark, sf_dir)
    users = v.stg_users.select(F.count(F.lit(1))).scalar()
    return v.stg_orders.agg(
        (F.count(F.lit(1)) / users).alias("avg_orders_per_user"),
        F.avg("quantity").alias("avg_quantity_per_order"),
    )


@query("join_left_first_last", oracle="""
SELECT user_id, username, bought[1] AS first_order, bought[-1] AS last_order,
       CAST(CAST(bought[-1] AS DATE) - CAST(bought[1] AS DATE) AS INTEGER) AS days_between
FROM (SELECT user_id, username FROM stg_users)
LEFT JOIN (SELECT user_id, list_sort(list(ordered_at)) AS bought FROM stg_orders GROUP BY user_id) USING (user_id)""", views=("stg_users",))
def q_join_left_first_last(spark, sf_dir):
    """J2 + A14: users without orders are kept (NULL dates). The order side
    is aggregated to one row per user before the join, so the join is
    user-sized rather than order-sized."""
    v = Views(spark, sf_dir)
    per_user = v.stg_orders.groupBy("user_id").agg(
        F.min("ordered_at").alias("first_order"), F.max("ordered_at").alias("last_order"))
    return v.stg_users.select("user_id", "username").join(per_user, "user_id", "left").select(
        "user_id", "username", "first_order", "last_order",
        S.days_between("first_order", "last_order").alias("days_between"),
    )


@query("ordered_every_product", oracle="""
SELECT user_id, username, name, len(bought) AS products_ordered
FROM stg_users JOIN (SELECT user_id, list_sort(list(DISTINCT product)) AS bought FROM stg_orders GROUP BY user_id) USING (user_id)
WHERE bought = (SELECT list_sort(list(DISTINCT product)) FROM stg_orders)""", views=("stg_users",))
def q_ordered_every_product(spark, sf_dir):
    """Distinct (user, product) pairs are computed first (partial
    aggregation), so the per-user count never sees raw order volume; the
    user attributes are joined to the (smaller) qualifying set."""
    v = Views(spark, sf_dir)
    qualifying = A.every_value_groups(v.stg_orders, ["user_id"], "product", "products_ordered")
    return v.stg_users.select("user_id", "username", "name").join(qualifying, "user_id")


@query("division_bitmap", oracle="""
SELECT user_id, len(bought) AS products_ordered
FROM (SELECT user_id, list_sort(list(DISTINCT product)) AS bought FROM stg_orders GROUP BY user_id)
WHERE bought = (SELECT list_sort(list(DISTINCT product)) FROM stg_orders)""", views=("stg_orders",))
def q_division_bitmap(spark, sf_dir):
    """A11 by bit sets: users who ordered every product."""
    return A.every_value_bits(Views(spark, sf_dir).stg_orders, ["user_id"], "product", "products_ordered")


@query("missing_city_by_state", oracle="""
SELECT state, count(*) AS users, CAST(sum(CASE WHEN city IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_city
FROM stg_users GROUP BY state""", views=("stg_users",))
def q_missing_city_by_state(spark, sf_dir):
    return A.conditional_count(Views(spark, sf_dir).stg_users, ["state"], F.col("city").isNull(), "missing_city")


@query("quantity_per_user", oracle="""
SELECT user_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM stg_orders GROUP BY user_id""",
       views=("stg_orders",))
def q_quantity_per_user(spark, sf_dir):
    return A.per_key_sum(Views(spark, sf_dir).stg_orders, "user_id", "quantity")


@query("quantity_per_user_grouped", oracle="""
SELECT user_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM stg_orders GROUP BY user_id""",
       views=("stg_orders",))
def q_quantity_per_user_grouped(spark, sf_dir):
    return A.per_key_sum_without_combine(Views(spark, sf_dir).stg_orders, "user_id", "quantity")


@query("user_order_stats", oracle="""
SELECT user_id, count(*) AS order_count, CAST(sum(quantity) AS BIGINT) AS quantity,
       sum(quantity) / count(*) AS avg_quantity
FROM stg_orders GROUP BY user_id""", views=("stg_orders",))
def q_user_order_stats(spark, sf_dir):
    return A.per_key_stats(Views(spark, sf_dir).stg_orders, "user_id", "quantity")


@query("pivot_month_product", oracle="SELECT month, " + ", ".join(
    f"CAST(sum(quantity) FILTER (WHERE product = '{p}') AS BIGINT) AS {p}" for p in DRIVER_PRODUCTS
) + " FROM (SELECT strftime(ordered_at, '%Y-%m') AS month, product, quantity FROM stg_orders) GROUP BY month",
       views=("stg_orders",))
def q_pivot_month_product(spark, sf_dir):
    o = Views(spark, sf_dir).stg_orders.select(S.month_label("ordered_at").alias("month"), "product", "quantity")
    return A.pivot_sum(o, "month", "product", DRIVER_PRODUCTS, "quantity")


@query("profile_exact", oracle="""
SELECT 'order_id' AS column_name, 'bigint' AS column_type, count(DISTINCT order_id) AS distinct_values,
       CAST(round(100.0 * count(*) FILTER (WHERE order_id IS NULL) / count(*), 2) AS DECIMAL(9,2)) AS null_percentage FROM stg_orders
UNION ALL SELECT 'user_id', 'bigint', count(DISTINCT user_id),
       CAST(round(100.0 * count(*) FILTER (WHERE user_id IS NULL) / count(*), 2) AS DECIMAL(9,2)) FROM stg_orders
UNION ALL SELECT 'ordered_at', 'timestamp_ntz', count(DISTINCT ordered_at),
       CAST(round(100.0 * count(*) FILTER (WHERE ordered_at IS NULL) / count(*), 2) AS DECIMAL(9,2)) FROM stg_orders
UNION ALL SELECT 'quantity', 'int', count(DISTINCT quantity),
       CAST(round(100.0 * count(*) FILTER (WHERE quantity IS NULL) / count(*), 2) AS DECIMAL(9,2)) FROM stg_orders
UNION ALL SELECT 'product', 'string', count(DISTINCT product),
       CAST(round(100.0 * count(*) FILTER (WHERE product IS NULL) / count(*), 2) AS DECIMAL(9,2)) FROM stg_orders""",
       views=("stg_orders",))
def q_profile_exact(spark, sf_dir):
    """A15 (exact form): one aggregation pass over all columns, then stack."""
    return A.profile_columns(Views(spark, sf_dir).stg_orders, exact=True)


@query("profile_columns", oracle="""
SELECT 'uuid' AS column_name, true AS close, CAST(round(100.0 * count(*) FILTER (WHERE uuid IS NULL) / count(*), 2) AS DECIMAL(9,2)) AS null_percentage FROM bronze_users
UNION ALL SELECT 'birthdate', true, CAST(round(100.0 * count(*) FILTER (WHERE birthdate IS NULL) / count(*), 2) AS DECIMAL(9,2)) FROM bronze_users""",
       views=("bronze_users",))
def q_profile_columns(spark, sf_dir):
    """A15 (SUMMARIZE form): HyperLogLog distinct estimates within a fifth of
    the exact counts (four deviations), and null percentages."""
    users = Views(spark, sf_dir).bronze_users.select("uuid", "birthdate")
    exact = A.profile_columns(users, exact=True).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("approx_unique") - F.col("exact")) <= F.col("exact") * 0.2
    return A.profile_columns(users, exact=False).join(exact, "column_name").select(
        "column_name", near.alias("close"), "null_percentage")


_ORDER_TYPES = {"uuid": "bigint", "user_uuid": "bigint", "date": "timestamp_ntz", "quantity": "int", "product": "string",
                "l_partkey": "bigint", "l_suppkey": "bigint", "l_extendedprice": "double"}


def _profile_sql(relation: str, extra: str = "") -> str:
    """Type, nulls and null percentage of every column; estimates are close to the exact counts."""
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, true AS close, {extra}count(*) - count({c}) AS nulls, "
        f"CAST(round(100.0 * (count(*) - count({c})) / count(*), 2) AS DECIMAL(9,2)) AS null_percentage FROM {relation}"
        for c, t in _ORDER_TYPES.items())


@query("profile_all_columns", oracle=_profile_sql("bronze_orders"), views=("bronze_orders",))
def q_profile_all_columns(spark, sf_dir):
    """A15 (SUMMARIZE form) of every column of bronze_orders: type, nulls, null
    percentage, and whether the distinct estimate is within a fifth of the exact
    count (four deviations)."""
    orders = stored(Views(spark, sf_dir).bronze_orders, "profile-orders", "zstd")
    exact = A.profile_columns(orders, exact=True, materialize=False).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("approx_unique") - F.col("exact")) <= F.col("exact") * 0.2
    return A.profile_columns(orders, exact=False, nulls=True).join(exact, "column_name").select(
        "column_name", "column_type", "nulls", "null_percentage", near.alias("close"))


_NULLED = "(SELECT * REPLACE (if(uuid % 10 = 0, NULL, product) AS product) FROM bronze_orders)"


@query("profile_merged", oracle=_profile_sql(_NULLED, "count(*) AS rows, "), views=("bronze_orders",))
def q_profile_merged(spark, sf_dir):
    """A15 by batches: two loads profiled apart, the stored sketches merged; the
    merged estimate is within 8 % (five deviations) of the exact count."""
    orders = Views(spark, sf_dir).bronze_orders.withColumn("product", F.when(F.col("uuid") % 10 != 0, F.col("product")))
    orders = stored(orders, "profile-orders", "zstd")       # the bronze joins run once, not once a load and once for the counts
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    early, late = orders.where(F.col("date") < cut), orders.where(F.coalesce(F.col("date") >= cut, F.lit(True)))
    parts = stored(A.profile_parts(early, "1"), "profile-1").unionByName(stored(A.profile_parts(late, "2"), "profile-2"))
    exact = A.profile_columns(orders, exact=True, materialize=False).select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("approx_unique") - F.col("exact")) <= F.greatest(F.col("exact") * 0.08, F.lit(1))
    return A.profile_merged(parts).join(exact, "column_name").select(
        "column_name", "column_type", "rows", "nulls", "null_percentage", near.alias("close"))


@query("running_total_daily", oracle="""
WITH daily AS (SELECT CAST(ordered_at AS DATE) AS day, CAST(sum(quantity) AS BIGINT) AS quantity FROM stg_orders GROUP BY 1)
SELECT now.day, now.quantity, CAST(sum(past.quantity) AS BIGINT) AS cumulative
FROM daily AS now JOIN daily AS past ON past.day <= now.day GROUP BY now.day, now.quantity""",
       views=("stg_orders",))
def q_running_total_daily(spark, sf_dir):
    daily = W.daily_totals(Views(spark, sf_dir).stg_orders, "ordered_at", "quantity")
    return W.running_total(daily, "day", "quantity")


@query("moving_avg_7", oracle="""
WITH daily AS (SELECT *, row_number() OVER (ORDER BY day) AS k FROM (SELECT CAST(ordered_at AS DATE) AS day, CAST(sum(quantity) AS BIGINT) AS quantity FROM stg_orders GROUP BY 1))
SELECT now.day, now.quantity, round(sum(near.quantity) / count(*), 1) AS avg_7d
FROM daily AS now JOIN daily AS near ON near.k > now.k - 7 AND near.k <= now.k GROUP BY now.day, now.quantity""",
       views=("stg_orders",))
def q_moving_avg_7(spark, sf_dir):
    daily = W.daily_totals(Views(spark, sf_dir).stg_orders, "ordered_at", "quantity")
    return W.moving_average(daily, "day", "quantity", rows=7, digits=1)


@query("best_product_per_month", oracle="""
SELECT month, product, quantity FROM (
  SELECT *, max(quantity) OVER (PARTITION BY month) AS best FROM (
    SELECT strftime(ordered_at, '%Y-%m') AS month, product, CAST(sum(quantity) AS BIGINT) AS quantity FROM stg_orders GROUP BY ALL))
WHERE quantity = best""", views=("stg_orders",))
def q_best_product_per_month(spark, sf_dir):
    o = Views(spark, sf_dir).stg_orders
    agg = o.groupBy(S.month_label("ordered_at").alias("month"), "product").agg(A.sum_long("quantity", "quantity"))
    return W.top_per_partition(agg, ["month"], "quantity")


@query("best_hour", oracle="""
WITH hours AS (SELECT CAST(strftime(ordered_at, '%H') AS INTEGER) AS hour_utc, CAST(sum(quantity) AS BIGINT) AS quantity FROM sales GROUP BY ALL)
SELECT * FROM hours WHERE NOT EXISTS (SELECT 1 FROM hours AS other WHERE other.quantity > hours.quantity)""", views=("sales",))
def q_best_hour(spark, sf_dir):
    s = Views(spark, sf_dir).sales
    agg = s.groupBy(F.hour("ordered_at").alias("hour_utc")).agg(A.sum_long("quantity", "quantity"))
    return W.top_overall(agg, "quantity")


@query("month_over_month", oracle="""
WITH sold AS (
  SELECT strftime(ordered_at, '%Y-%m') AS month, product, CAST(sum(quantity) AS BIGINT) AS quantity FROM stg_orders GROUP BY ALL)
SELECT now.month, now.product, now.quantity, before.quantity AS previous_quantity,
       round(100.0 * (now.quantity - before.quantity) / nullif(before.quantity, 0), 2) AS mom_pct
FROM sold AS now ASOF LEFT JOIN sold AS before ON now.product = before.product AND now.month > before.month""",
       views=("stg_orders",))
def q_month_over_month(spark, sf_dir):
    o = Views(spark, sf_dir).stg_orders
    monthly = o.groupBy(S.month_start("ordered_at").alias("m"), "product").agg(A.sum_long("quantity", "quantity"))
    out = W.change_vs_previous(monthly, ["product"], "m", "quantity", digits=2)
    return out.select(S.month_label("m").alias("month"), "product", "quantity", "previous_quantity", "mom_pct")


# ---------------------------------------------------------------- joins


@query("join_inner", oracle="""
SELECT o.order_id, o.user_id, u.username, o.product, o.quantity
FROM stg_orders o JOIN stg_users u ON o.user_id = u.user_id""", views=("stg_users",))
def q_join_inner(spark, sf_dir):
    v = Views(spark, sf_dir)
    return v.stg_orders.join(v.stg_users.select("user_id", "username"), "user_id").select(
        "order_id", "user_id", "username", "product", "quantity")


@query("join_enrich", oracle="""
SELECT o.uuid AS order_uuid, o.user_uuid, u.username
FROM bronze_orders o JOIN bronze_users u ON o.user_uuid = u.uuid""", views=("bronze_orders", "bronze_users"))
def q_join_enrich(spark, sf_dir):
    """Pair inner join (order -> (order, username))."""
    v = Views(spark, sf_dir)
    u = v.bronze_users.select(F.col("uuid").alias("user_uuid"), "username")
    return v.bronze_orders.select(F.col("uuid").alias("order_uuid"), "user_uuid").join(u, "user_uuid").select(
        "order_uuid", "user_uuid", "username")


@query("orphan_count", oracle="""
SELECT count(*) FILTER (WHERE user_id NOT IN (SELECT user_id FROM stg_users)) AS orphan_orders FROM dirty_orders""",
       views=("dirty_orders", "stg_users"))
def q_orphan_count(spark, sf_dir):
    """J3 on orders of which some name unknown users."""
    v = Views(spark, sf_dir)
    orphans = v.dirty_orders.join(v.stg_users.select("user_id"), "user_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_orders"))


@query("orphan_rows", oracle="""
SELECT order_id, user_id FROM dirty_orders EXCEPT ALL
SELECT order_id, user_id FROM dirty_orders JOIN stg_users USING (user_id)""", views=("dirty_orders", "stg_users"))
def q_orphan_rows(spark, sf_dir):
    """Left join + IS NULL written as left_anti (Catalyst keeps the
    outer-join form otherwise)."""
    v = Views(spark, sf_dir)
    return v.dirty_orders.join(v.stg_users.select("user_id"), "user_id", "left_anti").select("order_id", "user_id")


@query("inactive_parents", oracle="""
SELECT count(*) AS inactive_users FROM bronze_users u ANTI JOIN sales s ON s.user_id = u.uuid""",
       views=("bronze_users", "sales"))
def q_inactive_parents(spark, sf_dir):
    """Parents with no event at all. The events are reduced to distinct
    users first, so the anti join is user-sized and a hot user is one row."""
    v = Views(spark, sf_dir)
    active = v.sales.select(F.col("user_id").alias("uuid")).distinct()
    return v.bronze_users.join(active, "uuid", "left_anti").agg(F.count(F.lit(1)).alias("inactive_users"))


# ---------------------------------------------------------------- set operations / sort


@query("labelled_counts", oracle="""
SELECT 'bronze' AS layer, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity FROM bronze_orders
UNION ALL SELECT 'silver', count(*), CAST(sum(quantity) AS BIGINT) FROM stg_orders""", views=("stg_orders",))
def q_labelled_counts(spark, sf_dir):
    """UNION ALL of labelled summaries."""
    v = Views(spark, sf_dir)

    def summary(df, label):
        return df.agg(F.lit(label).alias("layer"), F.count(F.lit(1)).alias("orders"), A.sum_long("quantity", "quantity"))

    return summary(v.bronze_orders, "bronze").unionByName(summary(v.stg_orders, "silver"))


@query("duplicate_replay", oracle="""
WITH replay AS (SELECT * FROM stg_orders ORDER BY order_id LIMIT 3),
both_ AS (SELECT * FROM stg_orders UNION ALL SELECT * FROM replay)
SELECT (SELECT count(*) FROM stg_orders) AS original, (SELECT count(*) FROM both_) AS with_duplicates,
       (SELECT count(DISTINCT order_id) FROM both_) AS deduplicated""", views=("stg_orders",))
def q_duplicate_replay(spark, sf_dir):
    """U2 + O3: replay the lowest keys as duplicates and dedupe the union."""
    v = Views(spark, sf_dir)
    orders = stored(v.stg_orders, "replayed-orders")
    both = orders.unionByName(orders.orderBy("order_id").limit(3))
    deduplicated = latest_per_key(both, ["order_id"], [("ordered_at", "desc")], method="window")
    n = F.count(F.lit(1))
    return orders.agg(n.alias("original"), both.select(n).scalar().alias("with_duplicates"),
                      deduplicated.select(n).scalar().alias("deduplicated"))


@query("preview_rows", oracle="""
SELECT uuid, username, name, birthdate FROM bronze_users ORDER BY uuid LIMIT 3""", views=("bronze_users",))
def q_preview_rows(spark, sf_dir):
    """Column pruning + LIMIT preview (ordered so it is deterministic)."""
    return Views(spark, sf_dir).bronze_users.select("uuid", "username", "name", "birthdate").orderBy("uuid").limit(3)


# ---------------------------------------------------------------- filters / predicates


@query("date_filter_count", oracle="""
SELECT count(*) AS lines FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'""")
def q_date_filter_count(spark, sf_dir):
    """Range filter pushed to the Parquet scan (PushedFilters)."""
    li = Tables(spark, sf_dir).lineitem
    return li.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).agg(
        F.count(F.lit(1)).alias("lines"))


@query("date_filter_empty", oracle="""
SELECT count(*) AS lines FROM lineitem WHERE l_shipdate >= TIMESTAMP '2100-01-01'""")
def q_date_filter_empty(spark, sf_dir):
    """Every row group's max < bound, so the scan skips them all."""
    li = Tables(spark, sf_dir).lineitem
    return li.filter(F.col("l_shipdate") >= F.lit("2100-01-01").cast("timestamp_ntz")).agg(
        F.count(F.lit(1)).alias("lines"))


MONTHLY_REPORT_SQL = """
SELECT date_format(ordered_at, 'yyyy-MM') AS month, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity
FROM {orders}
WHERE :product IS NULL OR product = :product
GROUP BY 1
"""


def monthly_report(spark, orders_df, product=None):
    """Parameterised monthly report; product=None means all products.
    Bound parameters, never string pasting."""
    return spark.sql(MONTHLY_REPORT_SQL, args={"product": product}, orders=orders_df)


_MONTHLY_ORACLE = """
SELECT strftime(ordered_at, '%Y-%m') AS month, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity
FROM stg_orders WHERE {cond} GROUP BY 1"""


@query("monthly_report_all", oracle=_MONTHLY_ORACLE.format(cond="NULL IS NULL"), views=("stg_orders",))
def q_monthly_report_all(spark, sf_dir):
    return monthly_report(spark, Views(spark, sf_dir).stg_orders, None)


@query("monthly_report_one", oracle=_MONTHLY_ORACLE.format(cond="product = 'large'"), views=("stg_orders",))
def q_monthly_report_one(spark, sf_dir):
    return monthly_report(spark, Views(spark, sf_dir).stg_orders, "large")


@query("parameterised_sql", oracle="""
SELECT product, count(*) AS orders FROM stg_orders WHERE quantity >= 25 GROUP BY product""", views=("stg_orders",))
def q_parameterised_sql(spark, sf_dir):
    """Named session parameter bound into SQL text."""
    return spark.sql(
        "SELECT product, count(*) AS orders FROM {o} WHERE quantity >= :min_quantity GROUP BY product",
        args={"min_quantity": 25}, o=Views(spark, sf_dir).stg_orders)


@query("session_variable_report", oracle=_MONTHLY_ORACLE.format(cond="product = 'large' AND quantity >= 10"), views=("stg_orders",))
def q_session_variable_report(spark, sf_dir):
    """The monthly report with session variables (declared, set from a
    query, read by name) over a relation named by IDENTIFIER."""
    name = f"orders_{uuid.uuid4().hex[:8]}"
    Views(spark, sf_dir).stg_orders.createOrReplaceTempView(name)
    spark.sql("DECLARE OR REPLACE VARIABLE report_product STRING DEFAULT NULL")
    spark.sql("DECLARE OR REPLACE VARIABLE report_least INT DEFAULT 1")
    spark.sql("SET VARIABLE report_product = 'large'")
    spark.sql("SET VARIABLE report_least = (SELECT CAST(max(r_regionkey) + 6 AS INT) FROM {region})", region=Tables(spark, sf_dir).region)
    report = spark.sql("""
        SELECT date_format(ordered_at, 'yyyy-MM') AS month, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity
        FROM IDENTIFIER(:relation)
        WHERE (report_product IS NULL OR product = report_product) AND quantity >= report_least
        GROUP BY 1""", args={"relation": name})
    return report


@query("split_and_element", oracle="""
SELECT uuid, string_split(address, chr(10))[1] AS first_line, string_split(address, chr(10))[2] AS second_line, NULL::VARCHAR AS third_line,
       string_split(address, ' ')[-1] AS last_word FROM bronze_users""", views=("bronze_users",))
def q_split_and_element(spark, sf_dir):
    """2.9: split, and elements by place from either end; a place that is not there is null, not an error."""
    lines, words = F.split("address", "\n"), F.split("address", " ")
    at = lambda parts, k: F.try_element_at(parts, F.lit(k))
    return Views(spark, sf_dir).bronze_users.select("uuid", at(lines, 1).alias("first_line"), at(lines, 2).alias("second_line"),
                                                    at(lines, 3).alias("third_line"), at(words, -1).alias("last_word"))


@query("generated_uuids", oracle="SELECT count(*) AS rows, count(*) AS distinct_ids, count(*) AS shaped FROM customer")
def q_generated_uuids(spark, sf_dir):
    """2.9: a random UUID a row, all different and well formed."""
    ids = stored(Tables(spark, sf_dir).customer.select("c_custkey", F.uuid().alias("id")), "uuids")
    return ids.agg(F.count("*").alias("rows"), F.count_distinct("id").alias("distinct_ids"),
                   F.count_if(F.col("id").rlike(f"^{UUID_PATTERN}$")).alias("shaped"))


@query("filter_not_in_list", oracle="SELECT user_id, state FROM stg_users WHERE state NOT IN (" + ", ".join(
    f"'{s}'" for s in MILITARY_STATES) + ")", views=("stg_users",))
def q_filter_not_in_list(spark, sf_dir):
    """NOT IN with three-valued logic (a NULL state is not returned)."""
    u = Views(spark, sf_dir).stg_users
    return u.filter(~F.col("state").isin(*MILITARY_STATES)).select("user_id", "state")


@query("null_predicate", oracle="""
SELECT user_id, birthdate_original, birthdate_is_valid FROM stg_users WHERE birthdate IS NULL""",
       views=("stg_users",))
def q_null_predicate(spark, sf_dir):
    """P10."""
    u = Views(spark, sf_dir).stg_users
    return u.filter(F.col("birthdate").isNull()).select("user_id", "birthdate_original", "birthdate_is_valid")


# ---------------------------------------------------------------- scalar functions


@query("scalar_strings", oracle="""
SELECT uuid, trim(username) AS username_trim, upper(trim(sex)) AS sex_upper, lower(trim(mail)) AS email,
       split_part(address, chr(10), 1) AS street, split_part(address, chr(10), 3) AS line3,
       CAST(length(name) AS INTEGER) AS name_length, name || '/' || trim(sex) AS label,
       nullif(trim(sex), 'M') AS female_code
FROM bronze_users""", views=("bronze_users",))
def q_scalar_strings(spark, sf_dir):
    u = Views(spark, sf_dir).bronze_users
    return u.select(
        "uuid",
        F.trim("username").alias("username_trim"),
        S.upper_clean("sex").alias("sex_upper"),
        S.normalized("mail").alias("email"),
        S.address_line("address", 1).alias("street"),
        S.address_line("address", 3).alias("line3"),
        F.length("name").alias("name_length"),
        F.concat(F.col("name"), F.lit("/"), F.trim("sex")).alias("label"),
        F.nullif(F.trim("sex"), F.lit("M")).alias("female_code"),
    )


@query("scalar_regex", oracle="""
SELECT uuid,
       nullif(regexp_extract(split_part(address, chr(10), 2), '^(.+), [A-Z]{2} [0-9]{5}$', 1), '') AS city,
       regexp_extract(split_part(address, chr(10), 2), '([A-Z]{2}) ([0-9]{5})$', 1) AS state_raw,
       regexp_extract(address, '([A-Z]{2}) ([0-9]{5})$', 2) AS zip_raw,
       regexp_extract(split_part(address, chr(10), 1), '([A-Z]{2}) ([0-9]{5})$', 2) AS zip_line1
FROM bronze_users""", views=("bronze_users",))
def q_scalar_regex(spark, sf_dir):
    """regexp_extract: no match gives '' (kept raw here), NULL input gives NULL."""
    u = Views(spark, sf_dir).bronze_users
    l2 = S.address_line("address", 2)
    return u.select(
        "uuid",
        S.city_of(l2).alias("city"),
        F.regexp_extract(l2, r"([A-Z]{2}) ([0-9]{5})$", 1).alias("state_raw"),
        F.regexp_extract("address", r"([A-Z]{2}) ([0-9]{5})$", 2).alias("zip_raw"),
        F.regexp_extract(S.address_line("address", 1), r"([A-Z]{2}) ([0-9]{5})$", 2).alias("zip_line1"),
    )


@query("scalar_dates", oracle="""
SELECT order_id, CAST(ordered_at AS DATE) AS day,
       CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS month_start,
       strftime(ordered_at, '%Y-%m') AS month,
       CAST(hour(ordered_at) AS INTEGER) AS hour_utc,
       CAST(date_diff('day', CAST(date_trunc('month', ordered_at) AS DATE), CAST(ordered_at AS DATE)) AS INTEGER) AS day_of_month0,
       CAST(year(ordered_at) - year(DATE '2020-01-01') AS INTEGER) AS years_since_2020,
       ordered_at < DATE '2024-01-15' AS before_mid_january,
       CAST(strptime(strftime(ordered_at, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS reparsed_day
FROM sales""", views=("sales",))
def q_scalar_dates(spark, sf_dir):
    s = Views(spark, sf_dir).sales
    ts = F.col("ordered_at")
    return s.select(
        "order_id",
        S.day_of(ts).alias("day"),
        S.month_start(ts).alias("month_start"),
        S.month_label(ts).alias("month"),
        F.hour(ts).alias("hour_utc"),
        S.days_between(S.month_start(ts), ts).alias("day_of_month0"),
        S.year_diff(F.lit("2020-01-01").cast("date"), ts).alias("years_since_2020"),
        (ts < F.lit("2024-01-15").cast("date")).alias("before_mid_january"),
        F.to_date(F.date_format(ts, "yyyy-MM-dd"), "yyyy-MM-dd").alias("reparsed_day"),
    )


@query("scalar_math", oracle="""
SELECT order_id, CAST(quantity // 4 AS BIGINT) AS quarter_div, CAST((-quantity) // 4 AS BIGINT) AS neg_quarter_div,
       quantity / 4 AS quarter, round(quantity / 7, 2) AS seventh, 21 * 2 AS answer
FROM stg_orders""", views=("stg_orders",))
def q_scalar_math(spark, sf_dir):
    o = Views(spark, sf_dir).stg_orders
    return o.select(
        "order_id",
        F.expr("quantity div 4").alias("quarter_div"),
        F.expr("(-quantity) div 4").alias("neg_quarter_div"),
        (F.col("quantity") / 4).alias("quarter"),
        F.round(F.col("quantity") / 7, 2).alias("seventh"),
        F.lit(21 * 2).alias("answer"),
    )


@query("reference_states", oracle="""
SELECT s.code, count(u.user_id) AS users FROM states s LEFT JOIN stg_users u ON u.state = s.code GROUP BY s.code""",
       views=("states", "stg_users"))
def q_reference_states(spark, sf_dir):
    """The state seed (62 fixed rows, broadcast) joined to the users it
    classifies. Users are aggregated per state first; the join is then
    seed-sized."""
    v = Views(spark, sf_dir)
    per_state = v.stg_users.groupBy("state").agg(F.count(F.lit(1)).alias("users"))
    return F.broadcast(v.states).join(per_state, F.col("code") == F.col("state"), "left").select(
        "code", F.coalesce("users", F.lit(0)).alias("users"))
