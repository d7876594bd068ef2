"""Bucketed tables, mergeable profiles, bit-set division, batches taken back, seeds, dialects, file profiles."""

import random

import pytest
from pyspark.sql import functions as F

from silverline.operators import aggregates as A, versioned as V
from silverline.operators.dedupe import latest_per_key
from silverline.sinks import bucketed as BK, files as K
from silverline.sources import csv_split as CS, text as T


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def copies(spark):
    """(key, version, value) with copies, one hot key, null keys and a key of one side only."""
    rng = random.Random(2)
    rows = [(rng.randrange(400), rng.randrange(50), rng.randrange(9)) for _ in range(6000)]
    rows += [(7, i, i % 5) for i in range(4000)] + [(None, i, 1) for i in range(20)] + [(-5, 1, 1)]
    return spark.createDataFrame(rows, "k int, version int, value int")


ORDER = (("version", "desc"), ("value", "asc"))


def test_bucketed_dedupe_has_no_exchange_and_equals_the_shuffled_one(spark, copies):
    table = BK.write_bucketed(copies, "k", 8, "copies")
    assert table.hot.where("k = 7").count() > 4000 and table.hot.where("k <> 7").count() == 0 and table.hot.where("k IS NULL").count() == 20
    assert rows_of(table.rows()) == rows_of(copies)
    best = latest_per_key(table.even, ["k"], ORDER)
    assert "Exchange" not in plan_of(best) and "Bucketed: true" in plan_of(best)
    assert rows_of(table.by_key(lambda part: latest_per_key(part, ["k"], ORDER))) == rows_of(latest_per_key(copies, ["k"], ORDER))


def test_bucketed_join_has_no_exchange_and_equals_the_shuffled_one(spark, copies):
    other = spark.createDataFrame([(i, f"n{i}") for i in range(0, 500, 2)] + [(7, "seven"), (7, "again"), (None, "none")], "k int, name string")
    left, right = BK.write_bucketed(copies, "k", 8, "left"), BK.write_bucketed(other, "k", 8, "right")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        even = left.even.join(right.even, "k")
        assert "SortMergeJoin" in plan_of(even) and "Exchange" not in plan_of(even)
        assert rows_of(BK.join_bucketed(left, right)) == rows_of(copies.join(other, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        BK.join_bucketed(left, BK.write_bucketed(other, "k", 4, "right4"))


def test_bucketed_table_of_no_rows(spark, copies):
    empty = BK.write_bucketed(copies.limit(0), "k", 4, "empty")
    assert empty.rows().count() == 0
    BK.drop_tables(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("silverline_")]


def test_merged_profile_equals_the_whole_one(spark, copies):
    other = copies.withColumns({"name": F.concat(F.lit("n"), "value"), "at": F.col("version").cast("double")})
    halves = [other.where("version < 20"), other.where("version >= 20"), other.limit(0)]
    merged = {r["column_name"]: r for r in A.profile_merged(A.profile_parts(halves[0], "1").unionByName(A.profile_parts(halves[1], "2"))
                                                           .unionByName(A.profile_parts(halves[2], "3"))).collect()}
    whole = {r["column_name"]: r for r in A.profile_columns(other, exact=True, nulls=True).collect()}
    assert set(merged) == set(whole)
    for name, r in merged.items():
        assert (r["nulls"], r["null_percentage"], r["column_type"]) == (whole[name]["nulls"], whole[name]["null_percentage"], whole[name]["column_type"])
        assert r["rows"] == 10021 and abs(r["approx_unique"] - whole[name]["distinct_values"]) <= max(1, 0.08 * whole[name]["distinct_values"])


def test_merging_parts_reads_no_batch_again(spark, copies, tmp_path):
    A.profile_parts(copies, "1").write.parquet(str(tmp_path / "parts"))
    plan = plan_of(A.profile_merged(spark.read.parquet(str(tmp_path / "parts"))))
    assert plan.count("FileScan") == 1 and "parts" in plan


def test_division_by_bits(spark, copies):
    rng = random.Random(1)
    rows = [(u, rng.randrange(130)) for u in range(30) for _ in range(400)] + [(99, i) for i in range(130)] + [(100, None), (101, 5)]
    df = spark.createDataFrame(rows, "u int, v int")            # 130 values: three words
    want = sorted((u, 130) for u in {u for u, _ in rows} if {v for x, v in rows if x == u and v is not None} == set(range(130)))
    assert rows_of(A.every_value_bits(df, ["u"], "v", "n")) == want and (99, 130) in want
    assert A.every_value_bits(df.limit(0), ["u"], "v", "n").count() == 0


def test_a_batch_taken_back_is_gone_for_plain_reads(spark, tmp_path):
    root = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "a")], "id int, v string")
    V.write_batch(a, root, 1)
    with pytest.raises(ValueError):
        V.take_back(spark, root, 1)
    V.write_batch(spark.createDataFrame([(2, "b")], "id int, v string"), root, 2)
    V.write_batch(spark.createDataFrame([(3, "c", 1.0)], "id int, v string, extra double"), root, 3)
    V.take_back(spark, root, 3)
    assert rows_of(V.read_batches(spark, root)) == [(1, "a"), (2, "b")]
    V.write_batch(spark.createDataFrame([(4, "d", 2.0)], "id int, v string, extra double"), root, 3)
    assert rows_of(V.read_batches(spark, root).select("id", "v", "extra")) == [(1, "a", None), (2, "b", None), (4, "d", 2.0)]
    V.take_back(spark, root, 1)
    assert rows_of(V.read_batches(spark, root).select("id")) == [(2,), (4,)]


def test_seed_types(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('zip,n,"two\nlines"\n00501,7,1.5\n10001,8,2.5\n')
    seed = T.read_seed(spark, str(tmp_path / "seed.csv"), {"zip": "string"})
    assert seed.dtypes[:2] == [("zip", "string"), ("n", "int")] and seed.dtypes[2][1] == "double"
    assert [r["zip"] for r in seed.collect()] == ["00501", "10001"]
    with pytest.raises(ValueError):
        T.read_seed(spark, str(tmp_path / "seed.csv"), {"nope": "string"})


@pytest.mark.parametrize("sep, quote", [(";", "'"), ("|", '"'), ("\t", '"'), (",", '"')])
def test_quoted_dialects(spark, tmp_path, sep, quote):
    others = [d for d in ",;|\t" if d != sep]
    rng = random.Random(5)
    lines = []
    for i in range(60):
        text = "".join(rng.choice(others + ["x", "\n", sep, quote * 2]) for _ in range(rng.randrange(12)))
        lines.append(sep.join([str(i), f"{quote}{text}{quote}", "plain"]))
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    r = CS.sniff_quoted_dialect(spark, str(tmp_path / "a.csv")).first()
    assert (r["delimiter"], r["quote"], r["fields"], r["records"], r["share"]) == (sep, quote, 3, 60, 1.0)


def test_file_profiles(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.when(F.col("id") % 4 != 0, F.col("id").cast("string")).alias("s")).repartition(3).write.parquet(path)
    per = K.rows_per_file(spark, path).collect()
    assert len(per) == 3 and sum(r["rows"] for r in per) == 100 and all(r["file_size_in_bytes"] > 0 for r in per)
    got = K.file_profile(spark, path)
    assert got.where("column_name = 's'").agg(F.sum("nulls"), F.count("*")).first()[:] == (25, 3)
    assert got.where("column_name = 'id'").agg(F.min(F.col("least").cast("int")), F.max(F.col("largest").cast("int"))).first()[:] == (0, 99)
    assert "MapInPandas" not in plan_of(got)


def test_exact_profile_counts_column_by_column(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, None, 0.5), (2, "b", None), (None, "b", 1.5)], "k int, v string, x double")
    got = {r["column_name"]: (r["distinct_values"], r["nulls"]) for r in A.profile_columns(df, exact=True, nulls=True).collect()}
    assert got == {"k": (2, 1), "v": (2, 1), "x": (2, 1)}
    profile = A.profile_columns(df, exact=True)
    assert "Expand" not in plan_of(profile)                 # no row is multiplied by the columns
    assert A.profile_columns(df.limit(0).select("k"), exact=True).first()["distinct_values"] == 0
