"""Unit tests for reconciliation, streaming, batched tables and landing."""

import datetime as dt

import pytest
from pyspark.sql import DataFrame, functions as F

from silverline.operators import reconcile as R
from silverline.operators import versioned as V
from silverline.plans.q_io import BRONZE_ORDERS_SCHEMA
from silverline.plans.silver import ORDER_TIES
from silverline.sources import landing as L
from silverline.sources import text as T
from silverline.streaming import incremental as I


def test_diff_rows_is_multiset_difference_both_ways(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (4, "d"), (4, "d")], "k int, v string")
    got = sorted(tuple(r) for r in R.diff_rows(left, right).collect())
    want = sorted([(1, "a", "left_only"), (3, "c", "left_only"), (4, "d", "right_only"), (4, "d", "right_only")])
    assert got == want
    ref = left.exceptAll(right).count() + right.exceptAll(left).count()
    assert R.different_row_count(left, right, "m").collect()[0]["different_rows"] == ref == 4


def test_identical_frames(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v string")
    R.assert_identical(df, df.repartition(3), "same")
    with pytest.raises(AssertionError):
        R.assert_identical(df, df.limit(1), "fewer copies")


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(1, 2.0)], "id bigint, score double")
    rows = {r.column_name: (r.left_type, r.right_type) for r in R.schema_diff(spark, a, b).collect()}
    assert rows == {"id": ("int", "bigint"), "name": ("string", None), "score": (None, "double")}


def _orders(spark, rows):
    return spark.createDataFrame(rows, BRONZE_ORDERS_SCHEMA)


def test_incremental_dedupe_replay_is_idempotent(spark, tmp_path):
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    first = _orders(spark, [(1, 10, t1, 2, " a", 5, 6, 1.0), (2, 10, t1, 3, " b", 5, 6, 1.0)])
    newer = _orders(spark, [(1, 10, t2, 4, " a", 5, 6, 1.0)])
    landing, changes, ckpt = str(tmp_path / "in"), str(tmp_path / "chg"), str(tmp_path / "ck")

    def run():
        I.dedupe_increment(spark, landing, changes, ckpt, BRONZE_ORDERS_SCHEMA, ["uuid"], ORDER_TIES,
                           options=dict(T.CSV_OPTIONS))
        return {r.uuid: r.quantity for r in I.merged_view(spark, changes, ["uuid"], ORDER_TIES).collect()}

    T.write_csv(first, landing, mode="append")
    assert run() == {1: 2, 2: 3}
    T.write_csv(newer, landing, mode="append")
    assert run() == {1: 4, 2: 3}
    T.write_csv(first, landing, mode="append")  # replay of the first increment (older copies)
    assert run() == {1: 4, 2: 3}
    assert run() == {1: 4, 2: 3}  # nothing new: no change


def test_compaction_keeps_the_merged_view(spark, tmp_path):
    t1, t2, t3 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3)
    landing, changes, ckpt = str(tmp_path / "in"), str(tmp_path / "chg"), str(tmp_path / "ck")
    opts = dict(T.CSV_OPTIONS)

    def land_and_run(rows):
        T.write_csv(_orders(spark, rows), landing, mode="append")
        I.dedupe_increment(spark, landing, changes, ckpt, BRONZE_ORDERS_SCHEMA, ["uuid"], ORDER_TIES, options=opts)

    def view():
        return {r.uuid: r.quantity for r in I.merged_view(spark, changes, ["uuid"], ORDER_TIES).collect()}

    land_and_run([(1, 10, t1, 2, " a", 5, 6, 1.0), (2, 10, t1, 3, " b", 5, 6, 1.0)])
    land_and_run([(1, 10, t2, 4, " a", 5, 6, 1.0)])
    before = view()
    upto = I.compact(spark, changes, ["uuid"], ORDER_TIES)
    assert view() == before == {1: 4, 2: 3}
    land_and_run([(2, 10, t3, 9, " b", 5, 6, 1.0), (1, 10, t1, 1, " a", 5, 6, 1.0)])  # newer 2, stale 1
    assert view() == {1: 4, 2: 9}
    assert I.compact(spark, changes, ["uuid"], ORDER_TIES) > upto
    assert view() == {1: 4, 2: 9}


def test_incremental_landing_only_new_files(spark, tmp_path):
    t1 = dt.datetime(2020, 1, 1)
    batch = _orders(spark, [(i, 1, t1, 1, " a", 1, 1, 1.0) for i in range(5)])
    landing, target, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    T.write_csv(batch, landing, mode="append")
    I.land_increment(spark, landing, target, ckpt, BRONZE_ORDERS_SCHEMA, options=dict(T.CSV_OPTIONS))
    I.land_increment(spark, landing, target, ckpt, BRONZE_ORDERS_SCHEMA, options=dict(T.CSV_OPTIONS))
    assert spark.read.parquet(target).count() == 5


def test_guarded_append_rejects_duplicate_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    V.write_batch(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), root, 1)
    with pytest.raises(ValueError):
        V.guarded_append(spark, root, spark.createDataFrame([(2, "x")], "id long, v string"), ["id"], 2)
    V.guarded_append(spark, root, spark.createDataFrame([(3, "c")], "id long, v string"), ["id"], 2)
    assert V.read_batches(spark, root).count() == 3


def test_batches_keep_their_state_and_merge_columns(spark, tmp_path):
    root = str(tmp_path / "t")
    V.write_batch(spark.createDataFrame([(1,)], "id long"), root, 1)
    for _ in range(2):   # a repeated load replaces itself
        V.write_batch(spark.createDataFrame([(2, "spark")], "id long, source string"), root, 2)
    assert sorted(tuple(r) for r in V.read_batches(spark, root).collect()) == [(1, None), (2, "spark")]
    assert [r["id"] for r in V.read_batches(spark, root, upto=1).collect()] == [1]
    assert [tuple(r) for r in V.batch_summary(spark, root).orderBy("batch").collect()] == [(1, None, 1, 1), (2, 1, 1, 2)]
    with pytest.raises(ValueError):
        V.with_null_column(V.read_batches(spark, root), "source", "string")


def test_malformed_records_are_quarantined(spark, tmp_path):
    from pyspark.sql.types import StructType

    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "a.csv").write_text("a,b,c\n1,2,good\nx,5,tea\n3,4\n")
    I.land_increment(spark, str(landing), target, str(tmp_path / "ck"), StructType.fromDDL("a int, b int, c string"),
                     options=dict(T.CSV_OPTIONS))
    landed = spark.read.parquet(target)
    assert [tuple(r) for r in I.good_rows(landed).collect()] == [(1, 2, "good")]
    assert sorted(r[0] for r in I.quarantined(landed).collect()) == ["3,4", "x,5,tea"]


def test_failfast_sees_columns_that_are_not_used(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,qty\n1,2\n2,bad\n")
    rows = T.read_csv_typed(spark, str(tmp_path / "a.csv"), "id int, qty int", multiline=False)
    with pytest.raises(Exception):
        rows.agg(T.parsed_count(rows)).collect()
    (tmp_path / "a.csv").write_text("id,qty\n1,2\n2,\n")
    assert rows.agg(T.parsed_count(rows)).collect()[0][0] == 2


def test_blank_lines_of_any_white_space(spark, tmp_path):
    (tmp_path / "a.txt").write_text("head\n\t\n \nx\n")
    assert [r["value"] for r in T.drop_header_and_blank(T.read_lines(spark, str(tmp_path)), "head").collect()] == ["x"]


def test_header_is_found_whatever_the_sample(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,qty\n" + "".join(f"n{i},{i}\n" for i in range(300)))
    for fraction in (1.0, 0.5, 0.2):
        row = T.sniff_dialect(T.read_lines(spark, str(tmp_path)), sample_fraction=fraction).collect()[0]
        assert row["has_header"] and row["delimiter"] == ","


def test_checkpoint_folder_must_be_named_outside_local_masters():
    from silverline import session

    assert session.is_single_process("local[4]") and session.is_single_process("local") and session.is_single_process("local[2,3]")
    assert not session.is_single_process("local-cluster[3,2,1000]") and not session.is_single_process("yarn")

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_landing_copy_is_byte_identical_and_idempotent(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_bytes(b'id,name\n1,"x ""q"" y"\n')
    (src / "b.csv").write_bytes(b"id,name\n2,z\n")
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        log = L.land_files(spark, str(src), bronze, "users", "2024-01-01")
        assert log.count() == 2
    same = L.identical_files(spark, str(src), f"{bronze}/users/ingest_date=2024-01-01").collect()[0]
    assert (same.source_files, same.landed_files, same.identical_files) == (2, 2, 2)


def test_unknown_output_format_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        T.write_rows(spark.range(1), str(tmp_path / "x"), "xml")


def test_dialect_sniffing(spark, tmp_path):
    p = tmp_path / "semi.csv"
    p.write_text("id;name;qty\n1;a;2\n2;b;3\n3;c;4\n")
    row = T.sniff_dialect(T.read_lines(spark, str(p))).collect()[0]
    assert row.delimiter == ";" and row.has_header is True and row.quote == ""


def test_partition_balance_reports_both_methods(spark):
    from silverline.sinks import files as K

    out = K.partition_balance(spark.range(1000).repartition(4), 2).groupBy("method").agg(F.sum("rows")).collect()
    assert {r[0]: r[1] for r in out} == {"repartition": 1000, "coalesce": 1000}


def test_landing_queries_run_the_bronze_joins_once(spark, tmp_path, monkeypatch):
    """Early, late and replayed rows come from one stored table."""
    from silverline.plans import q_streaming as Q

    calls = []
    monkeypatch.setattr(Q, "_land_batch", lambda df, landing: calls.append(df._jdf.queryExecution().optimizedPlan().toString()) or T.write_csv(df, landing, mode="append"))
    spark.sql("""SELECT id AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 2D AS l_quantity, 3D AS l_extendedprice, 0D AS l_discount,
        0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, CAST(concat(1996 + id % 4, '-01-01') AS timestamp_ntz) AS l_shipdate FROM range(8)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("""SELECT id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1D AS o_totalprice, CAST('1996-01-01' AS timestamp_ntz) AS o_orderdate,
        '1' AS o_orderpriority FROM range(8)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 'tin' AS p_type, 1 AS p_size, 1D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    assert Q.q_incremental_dedupe(spark, str(tmp_path)).count() == 8
    assert len(calls) == 3 and not any("Join" in plan for plan in calls)


def test_incremental_dedupe_leaves_little_on_disk(spark, tmp_path, monkeypatch):
    """Landed files are compressed and bounded, batches are not kept, shuffle files go with their query."""
    from pathlib import Path

    from silverline.plans import q_streaming as Q

    key, kept, landings, land = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], [], Q._land_batch
    before = spark.conf.get(key, None)
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df) or df)
    monkeypatch.setattr(Q, "FILE_ROWS", 3, raising=False)
    monkeypatch.setattr(Q, "_land_batch", lambda df, landing: land(df, landing) or landings.append((landing.removeprefix("file:"), spark.conf.get(key, None))))
    spark.sql("""SELECT id AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 2D AS l_quantity, 3D AS l_extendedprice, 0D AS l_discount,
        0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, timestamp_ntz'1996-01-01' AS l_shipdate FROM range(0, 8, 1, 1)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("""SELECT id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1D AS o_totalprice, CAST('1996-01-01' AS timestamp_ntz) AS o_orderdate,
        '1' AS o_orderpriority FROM range(8)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 'tin' AS p_type, 1 AS p_size, 1D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    assert Q.q_incremental_dedupe(spark, str(tmp_path)).count() == 8
    files = [p.name for p in Path(landings[0][0]).glob("part-*")]
    assert len(files) >= 6 and all(name.endswith(".csv.gz") for name in files)
    assert [how for _, how in landings] == ["true"] * 3 and spark.conf.get(key, None) == before
    assert not kept


def test_malformed_records_of_a_deduplicated_batch_are_kept(spark, tmp_path):
    landing, changes = tmp_path / "in", str(tmp_path / "chg")
    t1 = dt.datetime(2020, 1, 1)

    def run():
        I.dedupe_increment(spark, str(landing), changes, str(tmp_path / "ck"), BRONZE_ORDERS_SCHEMA, ["uuid"], ORDER_TIES, options=dict(T.CSV_OPTIONS))
        return [sorted(r[0] for r in spark.read.parquet(f"{changes}/_quarantine/epoch={k}").collect()) for k in range(len(list((tmp_path / "chg" / "_quarantine").glob("epoch=*"))))]
    T.write_csv(_orders(spark, [(1, 10, t1, 2, " a", 5, 6, 1.0), (1, 10, t1, 3, " a", 5, 6, 1.0)]), str(landing), mode="append")
    assert run() == [[]]
    (landing / "bad.csv").write_text(",".join(BRONZE_ORDERS_SCHEMA.fieldNames()) + "\nx,1\n2,1\n")
    assert run() == [[], ["2,1", "x,1"]]
    assert [r.uuid for r in I.merged_view(spark, changes, ["uuid"], ORDER_TIES).collect()] == [1]
