"""Registered incremental-landing queries (2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from silverline.catalog import scratch_path, stored
from silverline.plans import silver
from silverline.plans.q_io import BRONZE_ORDERS_SCHEMA
from silverline.plans.registry import query
from silverline.plans.views import Views
from silverline.session import settings, shuffles_dropped
from silverline.sources import text as T
from silverline.streaming import incremental as I

CUT = "1998-01-01"  # first increment: orders shipped before this date


FILE_ROWS = 1_000_000  # of a compressed landed file

# A compressed file unpacks to four times its size, so fewer go to one task.
LANDED_SPLITS = {"spark.sql.files.maxPartitionBytes": "32m"}


def _land_plain(df, landing):
    T.write_csv(df, landing, mode="append")


def _land_batch(df, landing):
    """A landing that takes a third of the disk, and more seconds to write."""
    T.write_csv(df, landing, mode="append", compression="gzip", file_rows=FILE_ROWS)


def _read_options():
    return dict(T.CSV_OPTIONS)


@query("incremental_landing", oracle="SELECT * FROM bronze_orders", views=("bronze_orders",))
def q_incremental_landing(spark, sf_dir):
    """ST1: two landings, two availableNow runs; the second run only picks up
    the new files, and the bronze table ends with every record once."""
    bronze = Views(spark, sf_dir).bronze_orders
    root = scratch_path(spark, "incremental")
    landing, target, ckpt = f"{root}/landing", f"{root}/bronze_orders", f"{root}/_checkpoint"
    early = bronze.filter(F.col("date") < F.lit(CUT).cast("timestamp_ntz"))
    late = bronze.filter(F.col("date") >= F.lit(CUT).cast("timestamp_ntz"))
    _land_plain(early, landing)
    I.land_increment(spark, landing, target, ckpt, BRONZE_ORDERS_SCHEMA, options=_read_options())
    _land_plain(late, landing)
    I.land_increment(spark, landing, target, ckpt, BRONZE_ORDERS_SCHEMA, options=_read_options())
    return I.good_rows(spark.read.parquet(target))


@query("incremental_dedupe", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_incremental_dedupe(spark, sf_dir):
    """ST2: increments with natural duplicates plus a full replay of the first
    increment (new files, same records); silver keeps the latest copy per
    key and the replay adds no rows. The first two increments are compacted
    into a base before the replay arrives."""
    root = scratch_path(spark, "incremental-dedupe")
    landing, changes, ckpt = f"{root}/landing", f"{root}/changes", f"{root}/_checkpoint"
    with shuffles_dropped(spark), settings(spark, LANDED_SPLITS):
        bronze = stored(Views(spark, sf_dir).bronze_orders, "bronze-orders", "zstd")    # the joins run once, not once a landing
        early = bronze.filter(F.col("date") < F.lit(CUT).cast("timestamp_ntz"))
        late = bronze.filter(F.col("date") >= F.lit(CUT).cast("timestamp_ntz"))
        for i, batch in enumerate((early, late, early)):
            _land_batch(batch, landing)
            I.dedupe_increment(spark, landing, changes, ckpt, BRONZE_ORDERS_SCHEMA, ["uuid"], silver.ORDER_TIES,
                               options=_read_options())
            if i == 1:  # fold the first two increments into a base; the replay lands after it
                I.compact(spark, changes, ["uuid"], silver.ORDER_TIES)
    latest = I.merged_view(spark, changes, ["uuid"], silver.ORDER_TIES)
    return silver.typed_orders(latest)


@query("incremental_quarantine", oracle="""
SELECT 'good' AS part, count(*) AS records FROM bronze_orders
UNION ALL SELECT 'quarantined', 2 * count(*) FROM region
UNION ALL SELECT 'landed', (SELECT count(*) FROM bronze_orders) + 2 * (SELECT count(*) FROM region)""", views=("bronze_orders",))
def q_incremental_quarantine(spark, sf_dir):
    """ST1 with malformed records among the landed ones (wrong arity, bad
    integer; two per region): good and quarantined rows add up."""
    v = Views(spark, sf_dir)
    root = scratch_path(spark, "incremental-bad")
    landing, target, ckpt = f"{root}/landing", f"{root}/bronze_orders", f"{root}/_checkpoint"
    _land_plain(v.bronze_orders, landing)
    short = F.concat(F.col("r_regionkey").cast("string"), F.lit(",only two"))
    wrong = F.concat(F.lit("not-a-number,"), F.col("r_regionkey").cast("string"), F.lit(",1996-01-01T00:00:00.000,5,tea,1,2,3.0"))
    header = ",".join(BRONZE_ORDERS_SCHEMA.fieldNames())
    # the header is each file's first line, so one file
    bad = v.t.region.select(F.explode(F.array(short, wrong)).alias("value"))
    spark.sql("SELECT :h AS value", args={"h": header}).unionAll(bad).coalesce(1).write.mode("append").text(landing)
    I.land_increment(spark, landing, target, ckpt, BRONZE_ORDERS_SCHEMA,
                     options=dict(_read_options(), pathGlobFilter="part-*"))
    landed = spark.read.parquet(target)
    n = F.count(F.lit(1)).alias("records")
    return (I.good_rows(landed).agg(F.lit("good").alias("part"), n)
            .unionByName(I.quarantined(landed).agg(F.lit("quarantined").alias("part"), n))
            .unionByName(landed.agg(F.lit("landed").alias("part"), n)))


LANDED_ORDERS_SCHEMA = StructType([*BRONZE_ORDERS_SCHEMA.fields, StructField("landed_at", TimestampType())])


@query("stateful_dedupe", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_stateful_dedupe(spark, sf_dir):
    """ST2 with state: two increments, a replay of the first within the horizon,
    then a heartbeat past it. Every key is appended once, and the result is a
    plain scan of the target."""
    bronze = stored(Views(spark, sf_dir).bronze_orders, "bronze-orders", "zstd")
    root = scratch_path(spark, "stateful-dedupe")
    landing, target, ckpt = f"{root}/landing", f"{root}/orders", f"{root}/_checkpoint"
    early = bronze.filter(F.col("date") < F.lit(CUT).cast("timestamp_ntz"))
    late = bronze.filter(F.col("date") >= F.lit(CUT).cast("timestamp_ntz"))
    at = lambda df, day: df.withColumn("landed_at", F.lit(f"2024-03-0{day} 00:00:00").cast("timestamp"))
    for batch in (at(early, 1), at(late, 2), at(early, 4), I.heartbeat(spark, LANDED_ORDERS_SCHEMA, "landed_at", "2024-06-01 00:00:00")):
        _land_plain(batch, landing)
        I.dedupe_stateful(spark, landing, target, ckpt, LANDED_ORDERS_SCHEMA, ["uuid"], silver.ORDER_TIES, "landed_at",
                          options=_read_options())
    return silver.typed_orders(spark.read.parquet(target))
