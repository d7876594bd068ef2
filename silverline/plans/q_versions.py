"""Registered queries on batched tables (2.11): load, append, earlier states,
an added column, an insert with it, and the key guard."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.catalog import scratch_path
from silverline.operators import versioned as V
from silverline.plans.registry import query
from silverline.plans.views import Views

_LOWEST3 = "(SELECT * FROM stg_orders ORDER BY order_id LIMIT 3)"
_APPENDED = f"SELECT -order_id AS order_id, user_id, ordered_at, quantity, product FROM {_LOWEST3}"
_AFTER_APPEND = f"SELECT * FROM stg_orders UNION ALL {_APPENDED}"
_INSERTED = ("SELECT order_id, user_id, ordered_at, quantity, product, 'spark' AS source "
             "FROM (SELECT * FROM stg_orders ORDER BY order_id LIMIT 1)")
_EVOLVED = f"SELECT *, CAST(NULL AS VARCHAR) AS source FROM ({_AFTER_APPEND}) UNION ALL {_INSERTED}"


def _loaded(spark, sf_dir) -> str:
    root = scratch_path(spark, "batched-orders")
    V.write_batch(Views(spark, sf_dir).stg_orders, root, 1)
    return root


def _appended(spark, sf_dir) -> str:
    """Three new orders derived from the lowest keys, as batch 2."""
    root = _loaded(spark, sf_dir)
    lowest = V.read_batches(spark, root).orderBy("order_id").limit(3)
    V.write_batch(lowest.withColumn("order_id", -F.col("order_id")), root, 2)
    return root


def _evolved(spark, sf_dir) -> str:
    """One more row with a new column, as batch 3."""
    root = _appended(spark, sf_dir)
    one = V.read_batches(spark, root, upto=1).orderBy("order_id").limit(1)
    V.write_batch(one.withColumn("source", F.lit("spark")), root, 3)
    return root


@query("ver_create", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_ver_create(spark, sf_dir):
    """V1."""
    return V.read_batches(spark, _loaded(spark, sf_dir))


@query("ver_append", oracle=_AFTER_APPEND, views=("stg_orders",))
def q_ver_append(spark, sf_dir):
    """V2: append; earlier files stay."""
    return V.read_batches(spark, _appended(spark, sf_dir))


@query("ver_as_of", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_ver_as_of(spark, sf_dir):
    """V5: the state before the append, read after it."""
    return V.read_batches(spark, _appended(spark, sf_dir), upto=1)


@query("ver_rollback", oracle=_AFTER_APPEND, views=("stg_orders",))
def q_ver_rollback(spark, sf_dir):
    """V6: the third batch taken back: a plain read shows neither its row nor its column."""
    root = _evolved(spark, sf_dir)
    V.take_back(spark, root, 3)
    return V.read_batches(spark, root)


@query("ver_snapshots", oracle="""
SELECT CAST(1 AS INT) AS batch, CAST(NULL AS INT) AS parent, count(*) AS added_records, count(*) AS total_records FROM stg_orders
UNION ALL
SELECT 2, 1, 3, count(*) + 3 FROM stg_orders""", views=("stg_orders",))
def q_ver_snapshots(spark, sf_dir):
    """V3: batches with added and total records."""
    return V.batch_summary(spark, _appended(spark, sf_dir))


@query("ver_files", oracle="""
SELECT CAST(1 AS INT) AS batch, true AS has_files, count(*) AS record_count FROM stg_orders UNION ALL SELECT 2, true, 3""",
       views=("stg_orders",))
def q_ver_files(spark, sf_dir):
    """V4: files per batch and the records they hold."""
    files = V.batch_files(spark, _appended(spark, sf_dir))
    return files.groupBy("batch").agg((F.min("file_size_in_bytes") > 0).alias("has_files"),
                                      F.sum("record_count").alias("record_count"))


@query("ver_add_column", oracle=f"SELECT *, CAST(NULL AS VARCHAR) AS source FROM ({_AFTER_APPEND})", views=("stg_orders",))
def q_ver_add_column(spark, sf_dir):
    """V7: a nullable column; stored rows read NULL, no file is rewritten."""
    return V.with_null_column(V.read_batches(spark, _appended(spark, sf_dir)), "source", "string")


@query("ver_insert_evolved", oracle=_EVOLVED, views=("stg_orders",))
def q_ver_insert_evolved(spark, sf_dir):
    """V8: a row written with the added column."""
    return V.read_batches(spark, _evolved(spark, sf_dir))


@query("rows_by_source", oracle=f"SELECT source, count(*) AS rows FROM ({_EVOLVED}) GROUP BY source", views=("stg_orders",))
def q_rows_by_source(spark, sf_dir):
    """Group count over a nullable column; NULL is its own group."""
    return V.read_batches(spark, _evolved(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


@query("append_key_collisions", oracle="SELECT order_id FROM stg_orders ORDER BY order_id LIMIT 3", views=("stg_orders",))
def q_append_key_collisions(spark, sf_dir):
    """Replayed rows (same keys) collide with the table."""
    table = V.read_batches(spark, _loaded(spark, sf_dir))
    return V.key_collisions(table.orderBy("order_id").limit(3), table, ["order_id"])
