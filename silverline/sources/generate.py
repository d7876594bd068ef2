"""Seeded synthetic users and orders (S13, S14), generated by Spark tasks.

Every value is a pure function of (key, seed) via `xxhash64`, so the same
input and seed give the same rows on any cluster and any partitioning, and
nothing is built in the driver.

Orders: each user gets `n` orders with n in [count_min, count_max]; orders
occupy consecutive global hour slots in user order. The slot of a user's
first order is a prefix sum over the per-user counts, computed in two levels
so no single task sees all users: users are hashed into buckets, a window
per bucket gives the in-bucket prefix, and a window over the (few) bucket
totals gives each bucket's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverline.functions.reference import REFERENCE_PRODUCTS, STATE_CODES

# --- fixed values: invented name parts and cities for synthetic users.
FIRST_NAMES = ("Alex", "Blair", "Casey", "Dana", "Eli", "Frankie", "Gray", "Harper", "Indy", "Jules")
LAST_NAMES = ("Adams", "Baker", "Clark", "Diaz", "Evans", "Foster", "Garcia", "Hughes", "Ito", "Jones")
CITIES = ("Springfield", "Riverton", "Lakeside", "Fairview", "Oakdale", "Hillcrest", "Brookfield", "Ashland")


def _h(*cols: Column, seed: int, salt: str) -> Column:
    return F.xxhash64(*cols, F.lit(seed), F.lit(salt))


def _pick(values, h: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(h, F.lit(len(values))) + 1).cast("int"))


def _uuid_like(h1: Column, h2: Column) -> Column:
    """8-4-4-4-12 lower-case hex from two 64-bit hashes (UUID-shaped text)."""
    hx = F.lower(F.concat(F.lpad(F.hex(h1), 16, "0"), F.lpad(F.hex(h2), 16, "0")))
    return F.concat_ws("-", F.substring(hx, 1, 8), F.substring(hx, 9, 4), F.substring(hx, 13, 4),
                       F.substring(hx, 17, 4), F.substring(hx, 21, 12))


def generate_users(keys: DataFrame, key_col: str, seed: int = 42) -> DataFrame:
    """One synthetic user per input key (e.g. `spark.range(n)` or a
    table's key column)."""
    k = F.col(key_col)
    first = _pick(FIRST_NAMES, _h(k, seed=seed, salt="first"))
    last = _pick(LAST_NAMES, _h(k, seed=seed, salt="last"))
    username = F.lower(F.concat(first, F.lit("."), last, F.pmod(_h(k, seed=seed, salt="num"), F.lit(1000))))
    state = _pick(STATE_CODES[:51], _h(k, seed=seed, salt="state"))
    zip_code = F.lpad(F.pmod(_h(k, seed=seed, salt="zip"), F.lit(100000)).cast("string"), 5, "0")
    street = F.concat((F.pmod(_h(k, seed=seed, salt="street"), F.lit(9999)) + 1).cast("string"), F.lit(" Main St"))
    city = _pick(CITIES, _h(k, seed=seed, salt="city"))
    return keys.select(
        _uuid_like(_h(k, seed=seed, salt="u1"), _h(k, seed=seed, salt="u2")).alias("uuid"),
        username.alias("username"),
        F.concat(first, F.lit(" "), last).alias("name"),
        F.when(F.pmod(_h(k, seed=seed, salt="sex"), F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        F.concat(street, F.lit("\n"), city, F.lit(", "), state, F.lit(" "), zip_code).alias("address"),
        F.concat(username, F.lit("@example.com")).alias("mail"),
        F.date_add(F.lit("1930-01-01").cast("date"),
                   F.pmod(_h(k, seed=seed, salt="birth"), F.lit(30000)).cast("int")).alias("birthdate"),
    )


def generate_orders(users: DataFrame, count_min: int = 0, count_max: int = 100, seed: int = 42,
                    start: str = "2020-01-01 00:00:00", buckets: int = 1024,
                    products=REFERENCE_PRODUCTS) -> DataFrame:
    """Orders of every user, one per global hour slot. `buckets` is part of
    the slot order, like the seed: choose it once for a dataset, so that
    users / buckets rows fit a window partition."""
    if count_max < count_min:
        raise ValueError("count_max < count_min")
    u = users.select("uuid").withColumn(
        "n", (F.lit(count_min) + F.pmod(_h(F.col("uuid"), seed=seed, salt="count"),
                                        F.lit(count_max - count_min + 1))).cast("long")
    ).withColumn("bucket", F.pmod(F.xxhash64("uuid"), F.lit(buckets)))
    in_bucket = Window.partitionBy("bucket").orderBy("uuid").rowsBetween(Window.unboundedPreceding, -1)
    u = u.withColumn("prefix", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
    totals = u.groupBy("bucket").agg(F.sum("n").alias("bucket_total"))
    # `buckets` rows: a frame of a size the caller fixes, safe for an unpartitioned window and a broadcast.
    offsets = totals.withColumn(
        "offset", F.coalesce(F.sum("bucket_total").over(
            Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("bucket", "offset")
    u = u.join(F.broadcast(offsets), "bucket").withColumn("first_slot", F.col("offset") + F.col("prefix"))
    o = u.filter(F.col("n") > 0).select(
        "uuid", "first_slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    slot = F.col("first_slot") + F.col("i")
    base = F.lit(start).cast("timestamp_ntz")
    seconds = F.pmod(_h(F.col("uuid"), F.col("i"), seed=seed, salt="sec"), F.lit(3600))
    return o.select(
        _uuid_like(_h(F.col("uuid"), F.col("i"), seed=seed, salt="o1"),
                   _h(F.col("uuid"), F.col("i"), seed=seed, salt="o2")).alias("uuid"),
        F.col("uuid").alias("user_uuid"),
        (base + F.make_dt_interval(secs=(slot * 3600 + seconds).cast("decimal(18,6)"))).alias("date"),
        (F.pmod(_h(F.col("uuid"), F.col("i"), seed=seed, salt="qty"), F.lit(5)) + 1).cast("int").alias("quantity"),
        _pick(products, _h(F.col("uuid"), F.col("i"), seed=seed, salt="product")).alias("product"),
        slot.alias("hour_slot"),
    )
