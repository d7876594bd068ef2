"""Incremental landing with Structured Streaming (ST1, ST2).

Each run is a `trigger(availableNow=True)` batch: it processes exactly the
files that arrived since the last run (the file source remembers processed
files in the checkpoint) and stops. Exactly-once comes from the checkpoint
plus idempotent sinks:

* ST1 writes through the Parquet file sink, whose `_spark_metadata` log makes
  only committed files visible to readers;
* ST2 (`foreachBatch`) writes each micro-batch's deduplicated rows to its own
  `epoch=<id>` folder with overwrite, so a retried epoch replaces itself
  instead of doubling rows. Silver is merge-on-read: the latest version per
  key over all epochs (a partial + final aggregate, skew-safe); `compact`
  folds the epochs into a base, so reads take the base and the later epochs
  (compacted epochs stay stored until they are removed by hand);
* the stateful form keeps the winner of a key in the state store, as a session
  that lasts until no copy has arrived for a horizon, and appends it once then.
  Its target holds each key once, so reading it is a plain scan, and its state
  holds the keys of the last horizon only. The state is RocksDB's, on local disk
  with changes logged to the checkpoint, so its size is not bounded by the heap.
  Each partition's store has a write buffer of its own, a share of a fixed sum: of
  one budget for all, stores at rest would hold the most and those at work flush
  ever smaller files, until writes wait for compaction.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from silverline.operators.dedupe import Order, latest_per_key, rank_struct
from silverline.session import settings
from silverline.sources import fs


CORRUPT = "_corrupt_record"
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "false",        # see `state_on_disk`
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",    # each write would read the key first
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",                 # stores of an ended run are closed by then
}
WRITE_BUFFER = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB"
WRITE_BUFFERS_MB, LEAST_BUFFER_MB, MOST_BUFFER_MB = 1_500, 4, 64        # of all partitions together, of one


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """New streaming queries keep their state in RocksDB; a checkpoint goes on with the store it was begun with.

    Memory outside the heap grows with the number of state partitions up to a fixed sum, not with the state."""
    each = min(max(WRITE_BUFFERS_MB // int(spark.conf.get("spark.sql.shuffle.partitions")), LEAST_BUFFER_MB), MOST_BUFFER_MB)
    with settings(spark, STATE_ON_DISK | {WRITE_BUFFER: str(each)}):
        yield


def _file_stream(spark: SparkSession, landing_dir: str, schema: StructType, fmt: str, options: dict) -> DataFrame:
    """New files as rows of `schema` plus CORRUPT: the raw record where it does
    not parse (wrong arity, bad value), else null. Nothing is silently nulled."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    parsing = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return spark.readStream.schema(full).options(**options).options(**parsing).format(fmt).load(landing_dir)


def good_rows(landed: DataFrame) -> DataFrame:
    return landed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(landed: DataFrame) -> DataFrame:
    """Raw records that did not parse."""
    return landed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def land_increment(spark: SparkSession, landing_dir: str, target_dir: str, checkpoint: str,
                   schema: StructType, fmt: str = "csv", options: dict | None = None) -> None:
    """ST1: append every new landed file's records to the bronze table, parsed
    and malformed ones alike; `good_rows` and `quarantined` tell them apart, and
    together they are every landed record."""
    stream = _file_stream(spark, landing_dir, schema, fmt, options or {})
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(target_dir))
    q.awaitTermination()


def _store(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path, compression="zstd")


def dedupe_increment(spark: SparkSession, landing_dir: str, changes_dir: str, checkpoint: str,
                     schema: StructType, keys: Sequence[str], order, fmt: str = "csv",
                     options: dict | None = None) -> None:
    """ST2: per micro-batch keep the latest row per key and store it under
    `changes_dir/epoch=<id>`, malformed records under `changes_dir/_quarantine`
    (idempotent overwrite per epoch). The batch is not kept: malformed records are
    counted as it is deduplicated, and only where there are some it is read again."""

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        seen = Observation()
        counted = batch.observe(seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"))
        _store(latest_per_key(good_rows(counted), keys, order), f"{changes_dir}/epoch={epoch_id}")
        bad = quarantined(batch)
        _store(bad if seen.get.get("malformed", 1) else bad.limit(0), f"{changes_dir}/_quarantine/epoch={epoch_id}")

    stream = _file_stream(spark, landing_dir, schema, fmt, options or {})
    q = (stream.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _latest_compaction(spark: SparkSession, changes_dir: str) -> int | None:
    names = fs.list_names(spark, f"{changes_dir}/_compacted")
    done = [int(n.split("=", 1)[1]) for n in names if n.startswith("upto=")
            and fs.exists(spark, f"{changes_dir}/_compacted/{n}/_SUCCESS")]
    return max(done) if done else None


def merged_view(spark: SparkSession, changes_dir: str, keys: Sequence[str], order,
                upto: int | None = None) -> DataFrame:
    """Latest row per key across the stored epochs (replays and older copies
    lose to newer ones; equal copies collapse), optionally only epochs
    <= `upto`. After a compaction only the compacted base and the epochs
    after it are read (partition pruning on `epoch`), so read cost stays
    bounded as epochs accumulate."""
    base_upto = _latest_compaction(spark, changes_dir)
    deltas = spark.read.parquet(changes_dir)
    if upto is not None:
        deltas = deltas.filter(F.col("epoch") <= upto)
    if base_upto is None:
        return latest_per_key(deltas.drop("epoch"), keys, order)
    base = spark.read.parquet(f"{changes_dir}/_compacted/upto={base_upto}")
    newer = deltas.filter(F.col("epoch") > base_upto).drop("epoch")
    return latest_per_key(base.unionByName(newer), keys, order)


def compact(spark: SparkSession, changes_dir: str, keys: Sequence[str], order) -> int:
    """Fold every stored epoch into one base (`_compacted/upto=<epoch>`,
    hidden from the delta listing) and return that epoch. Readers switch to
    the base only once its `_SUCCESS` marker exists, so a failed or partial
    compaction changes nothing; re-running it overwrites the same folder."""
    epochs = [int(n.split("=", 1)[1]) for n in fs.list_names(spark, changes_dir) if n.startswith("epoch=")]
    if not epochs:
        raise ValueError("nothing to compact")
    upto = max(epochs)
    _store(merged_view(spark, changes_dir, keys, order, upto), f"{changes_dir}/_compacted/upto={upto}")
    return upto


def _ordered(stream: DataFrame, key: str) -> Column:
    """The key as it is grouped by. The store sorts an integer by its lowest byte, Spark's sort by value, so each
    lookup would go to another block; its eight bytes, the highest first, lie in one order in both."""
    if not isinstance(stream.schema[key].dataType, IntegralType):
        return F.col(key)
    return F.unhex(F.lpad(F.hex(F.col(key).cast("bigint")), 16, "0")).alias(f"_{key}")


def stateful_latest(stream: DataFrame, keys: Sequence[str], order: Order, arrived: str, horizon: str) -> DataFrame:
    """Streaming dedupe with state: the first row by `order` of each key, once no
    copy of it has arrived for `horizon`.

    `arrived` is the time of arrival, not of the event, so no row is late and none
    is dropped: it must not run backwards by landing. A copy that comes later than
    the horizon starts a new session and is appended again; choose the horizon
    above the longest replay. Rows without a key are no rows of the result, but
    their arrival moves the clock (see `heartbeat`)."""
    keep = [c for c in stream.columns if c not in (*keys, arrived)]
    winner = F.max_by(F.struct(*[F.col(c) for c in (*keys, *keep)]), rank_struct(stream, order))
    best = (stream.withWatermark(arrived, "0 seconds").groupBy(*[_ordered(stream, k) for k in keys], F.session_window(arrived, horizon))
            .agg(winner.alias("_w")).select("_w.*"))
    return best.where(F.concat(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) != "")


def dedupe_stateful(spark: SparkSession, landing_dir: str, target_dir: str, checkpoint: str, schema: StructType,
                    keys: Sequence[str], order: Order, arrived: str, horizon: str = "7 days", fmt: str = "csv",
                    options: dict | None = None) -> None:
    """One availableNow run of the stateful dedupe: settled rows are appended to
    `target_dir`, rows of malformed records with their text to
    `target_dir`_quarantine. A run starts from the checkpoint, state included."""
    options = options or {}
    landed = _file_stream(spark, landing_dir, schema, fmt, options)
    settled = stateful_latest(good_rows(landed), keys, order, arrived, horizon)
    runs = [(settled, target_dir, checkpoint),
            (_file_stream(spark, landing_dir, schema, fmt, options).where(F.col(CORRUPT).isNotNull()), f"{target_dir}_quarantine", f"{checkpoint}_quarantine")]
    with state_on_disk(spark):
        for frame, target, at in runs:
            (frame.writeStream.format("parquet").outputMode("append").option("checkpointLocation", at)
             .trigger(availableNow=True).start(target).awaitTermination())


def heartbeat(spark: SparkSession, schema: StructType, arrived: str, at: str) -> DataFrame:
    """A row without data that says the time has come to `at`: landing it settles
    every key whose horizon has passed."""
    return spark.range(1).select(*[(F.lit(at).cast("timestamp") if f.name == arrived else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
