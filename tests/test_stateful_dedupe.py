"""Streaming dedupe with state: replays, horizons, restarts from the checkpoint."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from silverline.streaming import incremental as I

SCHEMA = StructType([StructField("id", LongType()), StructField("v", IntegerType()), StructField("at", TimestampType())])
ORDER = (("v", "desc"),)


@pytest.fixture
def job(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / x) for x in ("landing", "target", "checkpoint"))

    def land(rows, day):
        df = spark.createDataFrame([(i, v) for i, v in rows], "id bigint, v int").withColumn("at", F.lit(f"2024-01-{day:02d}").cast("timestamp"))
        df.coalesce(1).write.mode("append").option("header", True).csv(landing)

    def run():
        """A run is a new query: it starts from the checkpoint alone."""
        I.dedupe_stateful(spark, landing, target, ckpt, SCHEMA, ["id"], ORDER, "at", "7 days", options={"header": "true"})
        return sorted(map(tuple, spark.read.schema("id bigint, v int").parquet(target).collect()))

    def beat(day):
        I.heartbeat(spark, SCHEMA, "at", f"2024-01-{day:02d}").write.mode("append").option("header", True).csv(landing)
    return land, run, beat, target


def test_each_key_is_appended_once_with_its_best_copy(job, spark):
    land, run, beat, target = job
    land([(1, 5), (1, 7), (2, 1)], 1)
    assert run() == []                              # still open
    land([(1, 6), (3, None), (3, 2)], 3)            # restart: state of key 1 is read back
    assert run() == []
    land([(1, 5), (2, 1)], 5)                       # a replay within the horizon
    run()
    beat(20)
    assert run() == [(1, 7), (2, 1), (3, 2)]
    assert run() == [(1, 7), (2, 1), (3, 2)]        # nothing new, nothing again
    assert spark.read.parquet(f"{target}_quarantine").count() == 0


def test_a_copy_after_the_horizon_is_a_new_session(job):
    land, run, beat, _ = job
    land([(1, 5)], 1)
    run()
    beat(12)
    assert run() == [(1, 5)]
    land([(1, 9)], 13)
    run()
    beat(28)
    assert run() == [(1, 5), (1, 9)]                # documented: the horizon bounds the state


def test_malformed_records_are_kept_apart(job, spark, tmp_path):
    land, run, beat, target = job
    land([(1, 5)], 1)
    (tmp_path / "landing" / "bad.csv").write_text("id,v,at\nx,1,2024-01-01\n4,2\n")
    run()
    beat(20)
    assert run() == [(1, 5)]
    assert sorted(r[I.CORRUPT] for r in spark.read.parquet(f"{target}_quarantine").collect()) == ["4,2", "x,1,2024-01-01"]


def test_state_not_rescans(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).csv(str(tmp_path)).where("id > 0")
    plan = I.stateful_latest(stream, ["id"], ORDER, "at", "7 days")._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" in plan and "session_window" in plan


def test_state_is_on_disk_and_settings_are_put_back(job, spark, tmp_path):
    land, run, beat, _ = job
    before = {key: spark.conf.get(key, None) for key in I.STATE_ON_DISK}
    land([(1, 5), (2, 1)], 1)
    run()
    beat(20)
    assert run() == [(1, 5), (2, 1)]
    kinds = {p.suffix for p in (tmp_path / "checkpoint" / "state").rglob("*") if p.is_file() and not p.name.startswith(".")}
    assert ".changelog" in kinds and ".delta" not in kinds
    assert before == {key: spark.conf.get(key, None) for key in I.STATE_ON_DISK}


def test_stores_share_no_write_budget(spark):
    """One budget would be held by stores at rest; each store has a share of a fixed sum."""
    prefix = "spark.sql.streaming.stateStore.rocksdb"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, each in ((8, "64"), (100, "15"), (5_000, "4")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            with I.state_on_disk(spark):
                assert spark.conf.get(f"{prefix}.boundedMemoryUsage") == "false"
                assert spark.conf.get(f"{prefix}.writeBufferSizeMB") == each
            assert spark.conf.get(f"{prefix}.writeBufferSizeMB", None) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_integer_keys_lie_in_the_store_as_they_are_sorted(spark):
    ids = [0, 1, 255, 256, 65_536, 2 ** 40, 2 ** 63 - 1, -2 ** 63, -1]      # negative ones come after the others
    df = spark.createDataFrame([(i, "x") for i in ids] + [(None, "y")], "id bigint, s string")
    kept = [r[0] for r in df.select(I._ordered(df, "id")).collect()]
    assert kept[-1] is None and all(len(k) == 8 for k in kept[:-1])
    assert sorted(map(bytes, kept[:-1])) == [bytes(k) for k in kept[:-1]]
    assert str(df.select(I._ordered(df, "s")).schema["s"].dataType) == "StringType()"


def test_integer_and_text_keys_together(spark, tmp_path):
    schema = StructType([StructField("a", IntegerType()), *spark.range(0).selectExpr("'' AS s").schema.fields, *SCHEMA.fields[1:]])
    landing, target, ckpt = (str(tmp_path / x) for x in ("landing", "target", "checkpoint"))
    rows = spark.createDataFrame([(-1, "x", 1), (-1, "x", 3), (-1, "y", 2), (7, "x", 4), (None, "x", 5), (None, "x", 6)], "a int, s string, v int")
    for df in (rows.withColumn("at", F.lit("2024-01-01").cast("timestamp")), I.heartbeat(spark, schema, "at", "2024-01-20")):
        df.write.mode("append").option("header", True).csv(landing)
        I.dedupe_stateful(spark, landing, target, ckpt, schema, ["a", "s"], ORDER, "at", "7 days", options={"header": "true"})
    got = sorted(map(tuple, spark.read.schema("a int, s string, v int").parquet(target).collect()), key=str)
    assert got == [(-1, "x", 3), (-1, "y", 2), (7, "x", 4), (None, "x", 6)]
