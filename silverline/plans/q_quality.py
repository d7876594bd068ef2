"""Registered data-quality queries (2.10) and reconciliation.

Each rule is declared once with its Spark form and the DuckDB text of its
violating rows; the report oracle is the UNION ALL of their counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from silverline.functions.reference import (
    BOOLEAN_VALUES, DRIVER_PRODUCTS, DRIVER_QUANTITIES, MILITARY_STATES, SEX_CODES,
)
from silverline.operators import quality as Q
from silverline.operators import reconcile as R
from silverline.plans import silver
from silverline.plans.registry import query
from silverline.plans.views import Views

def _in_list(values) -> str:
    return ", ".join(repr(v) if isinstance(v, str) else str(v).lower() for v in values)


# ---------------------------------------------------------------- singular tests


def birthdate_cleaning_violations(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Recompute flag and replacement independently; NULL-safe compare."""
    fo = orders.groupBy("user_id").agg(F.min(F.to_date("ordered_at")).alias("first_order_date"))
    j = users.join(fo, "user_id", "left")
    bo, fod = F.col("birthdate_original"), F.col("first_order_date")
    expected_flag = bo.isNotNull() & (fod.isNull() | (bo <= fod))
    expected_date = F.when(fod.isNotNull() & (bo > fod), F.lit(None).cast("date")).otherwise(bo)
    bad = ~F.col("birthdate_is_valid").eqNullSafe(expected_flag) | ~F.col("birthdate").eqNullSafe(expected_date)
    return j.filter(bad).select("user_id", "birthdate_original", "birthdate", "birthdate_is_valid", "first_order_date")


def events_before_birth(orders: DataFrame, users: DataFrame, birth_col: str) -> DataFrame:
    """Equi-join with an inequality residual (timestamp < date widens
    the date to midnight)."""
    u = users.select("user_id", F.col(birth_col).alias("birthdate"))
    j = orders.join(u, "user_id")
    return j.filter(F.col("ordered_at") < F.col("birthdate")).select("order_id", "ordered_at", "user_id", "birthdate")


def zip_state_violations(users: DataFrame, zip_states: DataFrame, exclude=MILITARY_STATES) -> DataFrame:
    """Users whose (zip, state) pair is not in the reference,
    classified as an unknown ZIP or a ZIP known under another state.
    Both lookups are anti/left joins against distinct reference keys; the
    reference grows with the data, so no forced broadcast (AQE decides)."""
    u = users.filter(~F.col("state").isin(*exclude)) if exclude else users
    pairs = zip_states.select("zip_code", "state").distinct()
    known = zip_states.select("zip_code").distinct().withColumn("_known", F.lit(True))
    bad = u.select("user_id", "state", "zip_code").join(pairs, ["zip_code", "state"], "left_anti")
    return bad.join(known, "zip_code", "left").select(
        "user_id", "state", "zip_code",
        F.when(F.col("_known").isNull(), F.lit("unknown_zip_in_reference"))
        .otherwise(F.lit("state_zip_mismatch")).alias("issue"),
    )


# ---------------------------------------------------------------- the silver contract


@dataclass(frozen=True)
class RuleSpec:
    name: str
    severity: str
    oracle: str  # DuckDB: violating rows, first column is the record key


_PRODS, _QTY = _in_list(DRIVER_PRODUCTS), _in_list(DRIVER_QUANTITIES)
_SEXES, _BOOLS, _MIL = _in_list(SEX_CODES), _in_list(BOOLEAN_VALUES), _in_list(MILITARY_STATES)

# Each oracle recomputes its finding by another route than the Spark rule: a
# correlated minimum, a filtered product, a list of states per ZIP.
BIRTHDATE_CLEANING_SQL = """
SELECT user_id, birthdate_original, birthdate, birthdate_is_valid, first_order_date
FROM (SELECT *, (SELECT CAST(min(x.ordered_at) AS DATE) FROM {orders} x WHERE x.user_id = {users}.user_id) AS first_order_date
      FROM {users})
WHERE birthdate_is_valid IS DISTINCT FROM coalesce(birthdate_original <= coalesce(first_order_date, birthdate_original), false)
   OR birthdate IS DISTINCT FROM if(first_order_date < birthdate_original, NULL, birthdate_original)"""

EVENT_BEFORE_BIRTH_SQL = """
SELECT order_id, ordered_at, born.user_id, born.birthdate
FROM (SELECT user_id, {col} AS birthdate FROM {users} WHERE {col} IS NOT NULL) AS born, stg_orders
WHERE stg_orders.user_id = born.user_id AND born.birthdate > stg_orders.ordered_at"""

ZIP_CLASSIFIED_SQL = f"""
SELECT user_id, state, zip_code, if(known IS NULL, 'unknown_zip_in_reference', 'state_zip_mismatch') AS issue
FROM stg_users LEFT JOIN (SELECT zip_code AS z, list(DISTINCT state) AS known FROM zip_states GROUP BY zip_code) ON z = zip_code
WHERE state NOT IN ({_MIL}) AND NOT coalesce(list_contains(known, state), false)"""


def _nn(table, col, key):
    return RuleSpec(f"not_null_{table}_{col}", "error", f"SELECT {key} FROM {table} WHERE {col} IS NULL")


def _uq(table, col):
    return RuleSpec(f"unique_{table}_{col}", "error",
                    f"SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")


def _av(table, col, key, values):
    return RuleSpec(f"accepted_values_{table}_{col}", "error", f"SELECT {key} FROM {table} WHERE {col} NOT IN ({values})")


# The silver layer's 28 checks (declarative column tests on both models and
# the seeds, then the singular SQL tests), as DuckDB text of violating rows.
CONTRACT_SPECS = [
    _uq("stg_users", "user_id"), _nn("stg_users", "user_id", "user_id"),
    _nn("stg_users", "username_normalized", "user_id"),
    _nn("stg_users", "birthdate_is_valid", "user_id"), _av("stg_users", "birthdate_is_valid", "user_id", _BOOLS),
    _uq("stg_users", "email"), _nn("stg_users", "email", "user_id"),
    _av("stg_users", "sex", "user_id", _SEXES),
    _nn("stg_users", "state", "user_id"),
    RuleSpec("relationships_stg_users_state__code__states", "error",
             "SELECT user_id FROM stg_users WHERE state IS NOT NULL AND state NOT IN (SELECT code FROM states)"),
    _uq("stg_orders", "order_id"), _nn("stg_orders", "order_id", "order_id"),
    _nn("stg_orders", "user_id", "order_id"),
    RuleSpec("relationships_stg_orders_user_id__user_id__stg_users", "error",
             "SELECT order_id FROM stg_orders o WHERE user_id IS NOT NULL AND NOT EXISTS "
             "(SELECT 1 FROM stg_users u WHERE u.user_id = o.user_id)"),
    _nn("stg_orders", "quantity", "order_id"), _av("stg_orders", "quantity", "order_id", _QTY),
    _nn("stg_orders", "product", "order_id"), _av("stg_orders", "product", "order_id", _PRODS),
    _uq("states", "code"), _nn("states", "code", "code"),
    _nn("zip_states", "zip_code", "zip_code"), _nn("zip_states", "state", "zip_code"),
    RuleSpec("assert_birthdate_cleaning", "error", BIRTHDATE_CLEANING_SQL.format(orders="stg_orders", users="stg_users")),
    RuleSpec("assert_orders_after_user_birth", "error", EVENT_BEFORE_BIRTH_SQL.format(col="birthdate", users="stg_users")),
    RuleSpec("assert_orders_have_users", "error",
             "SELECT o.order_id FROM stg_orders o LEFT JOIN stg_users u ON o.user_id = u.user_id WHERE u.user_id IS NULL"),
    RuleSpec("assert_quantity_positive", "error", "SELECT order_id FROM stg_orders WHERE quantity IS NULL OR quantity <= 0"),
    RuleSpec("assert_username_normalized", "error",
             "SELECT user_id FROM stg_users WHERE username_normalized IS NULL OR username_normalized != lower(trim(username))"),
    RuleSpec("assert_zip_matches_state", "warn", ZIP_CLASSIFIED_SQL),
]
SPEC_BY_NAME = {s.name: s for s in CONTRACT_SPECS}

# Rules on the bronze layer, where real violations exist.
BRONZE_SPECS = {
    "not_null_bronze_users_birthdate": "SELECT uuid FROM bronze_users WHERE birthdate IS NULL",
    "unique_bronze_orders_uuid": "SELECT uuid FROM bronze_orders WHERE uuid IS NOT NULL GROUP BY uuid HAVING count(*) > 1",
    "accepted_values_bronze_users_sex": f"SELECT uuid FROM bronze_users WHERE sex NOT IN ({_SEXES})",
    "relationships_dirty_orders_user_id__user_id__stg_users":
        "SELECT order_id FROM dirty_orders WHERE user_id NOT IN (SELECT user_id FROM stg_users)",
}


def checked_orders(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Orders with their user's attributes for the join-based checks. The
    user side is reduced to one row per user_id first, so the left join never
    multiplies order rows (duplicate user ids are the unique rule's finding)."""
    per_user = users.groupBy("user_id").agg(F.max("birthdate").alias("_u_birthdate"),
                                            F.max(F.lit(True)).alias("_u_found"))
    return orders.join(per_user, "user_id", "left")


def checked_users(users: DataFrame, orders: DataFrame, states: DataFrame, zip_states: DataFrame) -> DataFrame:
    """Users with every lookup the user checks need. Each right side is
    distinct on its join key, so rows are never multiplied; the state seed
    has a fixed size (62 rows) and is broadcast, the ZIP reference grows with
    the data and is left to AQE."""
    first = orders.groupBy("user_id").agg(F.min(F.to_date("ordered_at")).alias("_first_order_date"))
    codes = F.broadcast(states.select(F.col("code").alias("state")).distinct().withColumn("_state_known", F.lit(True)))
    pairs = zip_states.select("zip_code", "state").distinct().withColumn("_pair_known", F.lit(True))
    return (users.join(first, "user_id", "left").join(codes, "state", "left")
            .join(pairs, ["zip_code", "state"], "left"))


def contract(v: Views) -> list[Q.Rule]:
    """Spark form of CONTRACT_SPECS, same names and order.

    Checks are written as row-level predicates over one checked frame per
    model (joins done once), so `run_checks` evaluates all of a model's
    checks in a single aggregation pass; `unique` rules share one
    grouping-sets pass per frame."""
    u0, o0, st, zs = v.stg_users, v.stg_orders, v.states, v.zip_states
    o = checked_orders(o0, u0)
    u = checked_users(u0, o0, st, zs)
    bo, fod = F.col("birthdate_original"), F.col("_first_order_date")
    expected_flag = bo.isNotNull() & (fod.isNull() | (bo <= fod))
    expected_date = F.when(fod.isNotNull() & (bo > fod), F.lit(None).cast("date")).otherwise(bo)
    return [
        Q.unique(u0, "user_id", "unique_stg_users_user_id"),
        Q.not_null(u, "user_id", "user_id", "not_null_stg_users_user_id"),
        Q.not_null(u, "username_normalized", "user_id", "not_null_stg_users_username_normalized"),
        Q.not_null(u, "birthdate_is_valid", "user_id", "not_null_stg_users_birthdate_is_valid"),
        Q.accepted_values(u, "birthdate_is_valid", BOOLEAN_VALUES, "user_id", "accepted_values_stg_users_birthdate_is_valid"),
        Q.unique(u0, "email", "unique_stg_users_email"),
        Q.not_null(u, "email", "user_id", "not_null_stg_users_email"),
        Q.accepted_values(u, "sex", SEX_CODES, "user_id", "accepted_values_stg_users_sex"),
        Q.not_null(u, "state", "user_id", "not_null_stg_users_state"),
        Q.expression(u, "relationships_stg_users_state__code__states",
                     F.col("state").isNotNull() & F.col("_state_known").isNull(), "user_id"),
        Q.unique(o0, "order_id", "unique_stg_orders_order_id"),
        Q.not_null(o, "order_id", "order_id", "not_null_stg_orders_order_id"),
        Q.not_null(o, "user_id", "order_id", "not_null_stg_orders_user_id"),
        Q.expression(o, "relationships_stg_orders_user_id__user_id__stg_users",
                     F.col("user_id").isNotNull() & F.col("_u_found").isNull(), "order_id"),
        Q.not_null(o, "quantity", "order_id", "not_null_stg_orders_quantity"),
        Q.accepted_values(o, "quantity", DRIVER_QUANTITIES, "order_id", "accepted_values_stg_orders_quantity"),
        Q.not_null(o, "product", "order_id", "not_null_stg_orders_product"),
        Q.accepted_values(o, "product", DRIVER_PRODUCTS, "order_id", "accepted_values_stg_orders_product"),
        Q.unique(st, "code", "unique_states_code"),
        Q.not_null(st, "code", "code", "not_null_states_code"),
        Q.not_null(zs, "zip_code", "zip_code", "not_null_zip_states_zip_code"),
        Q.not_null(zs, "state", "zip_code", "not_null_zip_states_state"),
        Q.expression(u, "assert_birthdate_cleaning",
                     ~F.col("birthdate_is_valid").eqNullSafe(expected_flag) | ~F.col("birthdate").eqNullSafe(expected_date),
                     "user_id"),
        Q.expression(o, "assert_orders_after_user_birth", F.col("ordered_at") < F.col("_u_birthdate"), "order_id"),
        Q.expression(o, "assert_orders_have_users", F.col("_u_found").isNull(), "order_id"),
        Q.expression(o, "assert_quantity_positive", F.col("quantity").isNull() | (F.col("quantity") <= 0), "order_id",
                     columns=("quantity",)),
        Q.expression(u, "assert_username_normalized",
                     F.col("username_normalized").isNull() | (F.col("username_normalized") != F.lower(F.trim("username"))),
                     "user_id", columns=("username", "username_normalized")),
        Q.expression(u, "assert_zip_matches_state",
                     ~F.col("state").isin(*MILITARY_STATES) & F.col("_pair_known").isNull(), "user_id", severity="warn"),
    ]


def bronze_rules(v: Views) -> dict[str, Q.Rule]:
    bu, bo = v.bronze_users, v.bronze_orders
    return {
        "not_null_bronze_users_birthdate": Q.not_null(bu, "birthdate", "uuid", "not_null_bronze_users_birthdate"),
        "unique_bronze_orders_uuid": Q.unique(bo, "uuid", "unique_bronze_orders_uuid"),
        "accepted_values_bronze_users_sex": Q.accepted_values(bu, "sex", SEX_CODES, "uuid", "accepted_values_bronze_users_sex"),
        "relationships_dirty_orders_user_id__user_id__stg_users": Q.relationships(
            v.dirty_orders, "user_id", v.stg_users, "user_id", "order_id", "relationships_dirty_orders_user_id__user_id__stg_users"),
    }


def _report_oracle() -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{s.name}' AS rule, '{s.severity}' AS severity, count(*) AS failures FROM ({s.oracle})"
        for s in CONTRACT_SPECS)
    return f"""
SELECT rule, severity, failures,
       CASE WHEN failures = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'ERROR' END AS status
FROM ({rows})"""


# ---------------------------------------------------------------- queries

_VIEWS_ALL = ("stg_users", "dirty_orders", "sales", "zip_states", "states", "bronze_orders", "bronze_users")


def _long_query(key: str, prefix: str, bronze: str):
    names = [s.name for s in CONTRACT_SPECS if s.name.startswith(prefix) and not s.name.startswith("assert")]

    def run(spark, sf_dir):
        v = Views(spark, sf_dir)
        rules = [r for r in contract(v.checkpointed()) if r.name in names] + [bronze_rules(v)[bronze]]
        return Q.violations_long(rules)

    texts = [f"SELECT '{n}' AS rule, CAST(k AS VARCHAR) AS record_key FROM ({SPEC_BY_NAME[n].oracle}) AS x(k)"
             for n in names]
    texts.append(f"SELECT '{bronze}' AS rule, CAST(k AS VARCHAR) AS record_key FROM ({BRONZE_SPECS[bronze]}) AS x(k)")
    run.__name__ = f"q_{key}"
    query(key, oracle="\nUNION ALL\n".join(texts), views=_VIEWS_ALL)(run)


_long_query("dq_not_null", "not_null_", "not_null_bronze_users_birthdate")
_long_query("dq_unique", "unique_", "unique_bronze_orders_uuid")
_long_query("dq_accepted_values", "accepted_values_", "accepted_values_bronze_users_sex")
_long_query("dq_relationships", "relationships_", "relationships_dirty_orders_user_id__user_id__stg_users")


@query("dq_quantity_positive", oracle="SELECT order_id, quantity FROM dirty_orders WHERE NOT coalesce(quantity > 0, false)",
       views=("dirty_orders",))
def q_dq_quantity_positive(spark, sf_dir):
    """Q4 on orders with planted missing and zero quantities."""
    o = Views(spark, sf_dir).dirty_orders
    return Q.expression(o, "assert_quantity_positive", F.col("quantity").isNull() | (F.col("quantity") <= 0),
                        "order_id").violations().select("order_id", "quantity")


@query("dq_derived_column", oracle="""
SELECT user_id, username, username_normalized FROM dirty_users
WHERE username_normalized IS DISTINCT FROM lower(trim(username))""", views=("dirty_users",))
def q_dq_derived_column(spark, sf_dir):
    """Q5 on users with planted unnormalised names."""
    u = Views(spark, sf_dir).dirty_users
    bad = F.col("username_normalized").isNull() | (F.col("username_normalized") != F.lower(F.trim("username")))
    return Q.expression(u, "assert_username_normalized", bad, "user_id").violations().select(
        "user_id", "username", "username_normalized")


@query("dq_event_before_birth", oracle=EVENT_BEFORE_BIRTH_SQL.format(col="birthdate_original", users="stg_users"), views=("stg_users",))
def q_dq_event_before_birth(spark, sf_dir):
    """Q7 on the raw (original) birthdates: the violations cleaning removes."""
    v = Views(spark, sf_dir)
    return events_before_birth(v.stg_orders, v.stg_users, "birthdate_original")


@query("dq_event_before_birth_clean", oracle=EVENT_BEFORE_BIRTH_SQL.format(col="birthdate", users="dirty_users"), views=("dirty_users",))
def q_dq_event_before_birth_clean(spark, sf_dir):
    """Q7 on cleaned birthdates, of which every seventh was left uncleaned."""
    v = Views(spark, sf_dir)
    return events_before_birth(v.stg_orders, v.dirty_users, "birthdate")


@query("dq_birthdate_cleaning", oracle=BIRTHDATE_CLEANING_SQL.format(orders="stg_orders", users="dirty_users"), views=("dirty_users",))
def q_dq_birthdate_cleaning(spark, sf_dir):
    """Q9/P8 on users with planted wrong flags and uncleaned dates."""
    v = Views(spark, sf_dir)
    return birthdate_cleaning_violations(v.dirty_users, v.stg_orders)


@query("dq_zip_state_classified", oracle=ZIP_CLASSIFIED_SQL, views=("stg_users", "zip_states"))
def q_dq_zip_state_classified(spark, sf_dir):
    v = Views(spark, sf_dir)
    return zip_state_violations(v.stg_users, v.zip_states)


@query("dq_zip_state_summary", oracle="SELECT issue, count(*) AS users FROM (" + ZIP_CLASSIFIED_SQL + ") GROUP BY issue",
       views=("stg_users", "zip_states"))
def q_dq_zip_state_summary(spark, sf_dir):
    v = Views(spark, sf_dir)
    return zip_state_violations(v.stg_users, v.zip_states).groupBy("issue").agg(F.count(F.lit(1)).alias("users"))


@query("dq_pair_not_in_reference", oracle="""
SELECT u.user_id, u.state, u.zip_code FROM stg_users u
WHERE NOT EXISTS (SELECT 1 FROM zip_states z WHERE z.zip_code = u.zip_code AND z.state = u.state)""",
       views=("stg_users", "zip_states"))
def q_dq_pair_not_in_reference(spark, sf_dir):
    """Correlated NOT EXISTS on two keys -> left_anti on both."""
    v = Views(spark, sf_dir)
    pairs = v.zip_states.select("zip_code", "state").distinct()
    return v.stg_users.select("user_id", "state", "zip_code").join(pairs, ["zip_code", "state"], "left_anti").select(
        "user_id", "state", "zip_code")


@query("dq_report", oracle=_report_oracle(), views=("stg_users", "zip_states", "states"))
def q_dq_report(spark, sf_dir):
    """Q11/Q12/M6: the whole silver contract as one report frame."""
    return Q.run_checks(contract(Views(spark, sf_dir).checkpointed()))


# ---------------------------------------------------------------- reconciliation


@query("reconcile_same", oracle="""
SELECT 'orders' AS model, (SELECT count(*) FROM (SELECT * FROM stg_orders EXCEPT ALL
  (SELECT uuid, user_uuid, arg_min(date, r), arg_min(quantity, r), lower(trim(arg_min(product, r)))
   FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY date DESC, l_partkey, l_suppkey, l_extendedprice, quantity) AS r
         FROM bronze_orders) WHERE r = 1 GROUP BY uuid, user_uuid))) AS different_rows
UNION ALL
SELECT 'users', (SELECT count(*) FROM bronze_users) - (SELECT count(*) FROM stg_users)""", views=("stg_users",))
def q_reconcile_same(spark, sf_dir):
    """The DataFrame-API models equal their SQL-text versions
    (EXCEPT ALL both ways, counted)."""
    v = Views(spark, sf_dir)
    bronze_o = v.bronze_orders
    bronze_u = v.bronze_users
    so = silver.stg_orders_sql(spark, bronze_o)
    su = silver.stg_users_sql(spark, bronze_u, so)
    return R.different_row_count(v.stg_orders, so, "orders").unionByName(
        R.different_row_count(v.stg_users, su, "users"))


@query("reconcile_diff", oracle="""
SELECT *, 'left_only' AS side FROM (
  SELECT uuid AS order_id, user_uuid AS user_id, date AS ordered_at, quantity, lower(trim(product)) AS product FROM bronze_orders
  EXCEPT ALL SELECT * FROM stg_orders)
UNION ALL
SELECT *, 'right_only' AS side FROM (
  SELECT * FROM stg_orders EXCEPT ALL
  SELECT uuid AS order_id, user_uuid AS user_id, date AS ordered_at, quantity, lower(trim(product)) AS product FROM bronze_orders)""",
       views=("stg_orders",))
def q_reconcile_diff(spark, sf_dir):
    """M4: rows that differ between the typed bronze orders and the silver
    model (the duplicates the dedupe removed), labelled by side."""
    v = Views(spark, sf_dir)
    return R.diff_rows(silver.typed_orders(v.bronze_orders), v.stg_orders)


_USER_COLUMNS = ("user_id", "username", "username_normalized", "birthdate_original", "birthdate", "birthdate_is_valid")


@query("reconcile_users_diff", oracle=f"""
SELECT u.*, 'left_only' AS side FROM (SELECT {", ".join(_USER_COLUMNS)} FROM stg_users) u
WHERE user_id IN (SELECT d.user_id FROM dirty_users d JOIN stg_users s USING (user_id) WHERE d.birthdate IS DISTINCT FROM s.birthdate
  OR d.birthdate_is_valid IS DISTINCT FROM s.birthdate_is_valid OR d.username_normalized IS DISTINCT FROM s.username_normalized)
UNION ALL
SELECT d.*, 'right_only' FROM (SELECT {", ".join(_USER_COLUMNS)} FROM dirty_users) d
WHERE user_id IN (SELECT d.user_id FROM dirty_users d JOIN stg_users s USING (user_id) WHERE d.birthdate IS DISTINCT FROM s.birthdate
  OR d.birthdate_is_valid IS DISTINCT FROM s.birthdate_is_valid OR d.username_normalized IS DISTINCT FROM s.username_normalized)""",
       views=("stg_users", "dirty_users"))
def q_reconcile_users_diff(spark, sf_dir):
    """M4, users: rows that differ between the silver users and a faulty copy, by side."""
    v = Views(spark, sf_dir)
    return R.diff_rows(v.stg_users.select(*_USER_COLUMNS), v.dirty_users.select(*_USER_COLUMNS))


@query("reconcile_summary", oracle="""
SELECT 'bronze' AS engine, count(*) AS rows, CAST(sum(quantity) AS BIGINT) AS sum_quantity FROM bronze_orders
UNION ALL SELECT 'silver', count(*), CAST(sum(quantity) AS BIGINT) FROM stg_orders""", views=("stg_orders",))
def q_reconcile_summary(spark, sf_dir):
    v = Views(spark, sf_dir)
    return R.summary(v.bronze_orders, v.stg_orders, "quantity", "bronze", "silver")


@query("silver_build", oracle=_report_oracle(), views=("stg_users", "zip_states", "states"))
def q_silver_build(spark, sf_dir):
    """M6: the whole silver build; returns the check report of the stored tables."""
    from silverline.catalog import scratch_path
    from silverline.plans.build import build_silver

    return build_silver(spark, sf_dir, scratch_path(spark, "silver-build"))


@query("silver_build_observed", oracle=_report_oracle(), views=("stg_users", "zip_states", "states"))
def q_silver_build_observed(spark, sf_dir):
    """Q11/M6: the silver build with its row-level checks counted while the models are written."""
    from silverline.catalog import scratch_path
    from silverline.plans.build import build_silver_observed

    return build_silver_observed(spark, sf_dir, scratch_path(spark, "silver-observed"))


_RUN_RULES = ("not_null_quantity", "quantity_positive", "unknown_user", "product_listed")
_RUN_SQL = f"""
SELECT 'not_null_quantity' AS rule, order_id FROM {{o}} WHERE quantity IS NULL
UNION ALL SELECT 'quantity_positive', order_id FROM {{o}} WHERE quantity <= 0
UNION ALL SELECT 'unknown_user', order_id FROM {{o}} WHERE user_id NOT IN (SELECT user_id FROM stg_users)
UNION ALL SELECT 'product_listed', order_id FROM {{o}} WHERE product NOT IN ({_PRODS})"""


def _run_rules(orders: DataFrame, users: DataFrame) -> list[Q.Rule]:
    return [Q.not_null(orders, "quantity", "order_id", "not_null_quantity"),
            Q.expression(orders, "quantity_positive", F.col("quantity") <= 0, "order_id"),
            Q.relationships(orders, "user_id", users, "user_id", "order_id", "unknown_user"),
            Q.accepted_values(orders, "product", DRIVER_PRODUCTS, "order_id", "product_listed")]


def _audited_runs(spark, sf_dir) -> str:
    """Three builds on orders with planted faults: the first; a second; the second again, after its missing quantities were filled."""
    from silverline.catalog import scratch_path, stored

    v = Views(spark, sf_dir)
    orders = stored(v.dirty_orders, "dirty-orders")
    audit = scratch_path(spark, "audit")
    Q.store_failures_of_run(_run_rules(orders, v.bronze_users.select(F.col("uuid").alias("user_id"))), audit, "2024-01-01")
    late = orders.where("order_id % 2 = 0")
    Q.store_failures_of_run(_run_rules(late, v.bronze_users.select(F.col("uuid").alias("user_id"))), audit, "2024-01-02")
    filled = late.withColumn("quantity", F.coalesce("quantity", F.lit(1)))
    Q.store_failures_of_run(_run_rules(filled, v.bronze_users.select(F.col("uuid").alias("user_id"))), audit, "2024-01-02")
    return audit


_LATE = "(SELECT * REPLACE (coalesce(quantity, 1) AS quantity) FROM dirty_orders WHERE order_id % 2 = 0)"


@query("stored_failures_by_run", oracle=f"""
SELECT f.rule, '2024-01-01' AS run, CAST(f.order_id AS VARCHAR) AS record_key, o.user_id, o.quantity, o.product
FROM ({_RUN_SQL.format(o="dirty_orders")}) f JOIN dirty_orders o USING (order_id)
UNION ALL
SELECT f.rule, '2024-01-02', CAST(f.order_id AS VARCHAR), o.user_id, o.quantity, o.product
FROM ({_RUN_SQL.format(o=_LATE)}) f JOIN {_LATE} o USING (order_id)""", views=("stg_users", "dirty_orders"))
def q_stored_failures_by_run(spark, sf_dir):
    """Q11: stored failures of two runs, the second one repeated, read back with their rows."""
    rows = Q.read_failures(spark, _audited_runs(spark, sf_dir))
    record = F.from_json("record", "user_id bigint, quantity int, product string").alias("r")
    return rows.select("rule", "run", "record_key", record).select("rule", "run", "record_key", "r.user_id", "r.quantity", "r.product")


@query("failures_by_run", oracle=f"""
WITH rules AS (SELECT unnest({list(_RUN_RULES)}) AS rule), runs AS (SELECT unnest(['2024-01-01', '2024-01-02']) AS run),
found AS (SELECT rule, '2024-01-01' AS run FROM ({_RUN_SQL.format(o="dirty_orders")})
          UNION ALL SELECT rule, '2024-01-02' FROM ({_RUN_SQL.format(o=_LATE)}))
SELECT rule, run, (SELECT count(*) FROM found f WHERE f.rule = rules.rule AND f.run = runs.run) AS failures FROM rules, runs""",
       views=("stg_users", "dirty_orders"))
def q_failures_by_run(spark, sf_dir):
    """Q11: number of failures by rule and run, rules that passed included."""
    return Q.failures_by_run(spark, _audited_runs(spark, sf_dir))


@query("schema_difference", oracle="""
SELECT 'birthdate' AS column_name, 'date' AS left_type, 'string' AS right_type UNION ALL SELECT 'loaded_at', NULL, 'timestamp'
UNION ALL SELECT 'zip_code', 'string', NULL""")
def q_schema_difference(spark, sf_dir):
    """M4: columns of the silver users and of a copy stored by another tool whose presence or type differs."""
    from silverline.catalog import stored

    users = Views(spark, sf_dir).stg_users
    other = stored(users.drop("zip_code").withColumns({"birthdate": F.col("birthdate").cast("string"), "loaded_at": F.current_timestamp()}), "other-users")
    return R.schema_diff(spark, users, other)
