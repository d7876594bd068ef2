"""Multi-line CSV read in blocks, against the `multiLine` reader."""

import csv
import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverline.sources import csv_split as CS, text as T

SCHEMA = StructType([StructField("id", LongType()), StructField("a", StringType()), StructField("b", StringType())])


@pytest.fixture
def block(spark):
    """Sets the size of a block."""
    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return "\n".join(rng.choice(["", 'say ""', '"q"', "x,y", " pad ", "é"]) for _ in range(rng.randrange(2, 9)))
    if kind == 1:
        return '"' * rng.randrange(1, 5) + "tail"
    if kind == 2:
        return "one\r\ntwo\n"
    return rng.choice(["plain", " pad ", "a,b", "é×", "x" * rng.randrange(1, 90)])


def written(path, rows, end="\n", header=True):
    path.mkdir(exist_ok=True)
    with open(path / f"part-{len(list(path.iterdir()))}.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        if header:
            w.writerow(SCHEMA.fieldNames())
        w.writerows(rows)
    return str(path)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.mark.parametrize("size, end", [(150, "\n"), (150, "\r\n"), (2000, "\n")])
def test_equals_the_multiline_read(spark, tmp_path, block, size, end):
    rng = random.Random(size)
    path = tmp_path / "csv"
    every = []
    for k in range(2):
        rows = [(1000 * k + i, field(rng), field(rng)) for i in range(40)]
        every += rows
        written(path, rows, end)
    block(size)
    got = CS.read_csv_split(spark, str(path), SCHEMA)
    assert rows_of(got) == sorted(every, key=repr)
    if end == "\n":
        assert rows_of(got) == rows_of(T.read_csv_typed(spark, str(path), SCHEMA))
    lines = CS.numbered_lines(spark, str(path))
    blocks = lines.select("file", "block").distinct().count()
    assert blocks > (10 if size < 1000 else 2)
    assert "multiLine" not in got._jdf.queryExecution().toString()


def test_record_of_many_blocks_and_empty_files(spark, tmp_path, block):
    path = tmp_path / "csv"
    long = "\n".join(f"line {i}" for i in range(200))
    rows = [(1, long, "x"), (2, "y", "z"), (3, long + '"', long)]
    written(path, rows)
    written(path, [])
    (path / "part-9.csv").write_text("")
    (path / "part-8.csv").write_text('id,a,b\n\n4,"",\n\n5,b,c')
    block(300)
    assert rows_of(CS.read_csv_split(spark, str(path), SCHEMA)) == rows_of(T.read_csv_typed(spark, str(path), SCHEMA))
    records, long_ = CS.csv_records(spark, str(path))
    assert {r["n_lines"] for r in records.collect()} == {1, 200, 399} and long_.count() == 0


def test_multi_line_header_and_no_header(spark, tmp_path, block):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text('id,"a\nof two lines",b\n1,"x\ny",z\n')
    block(10)
    assert rows_of(CS.read_csv_split(spark, str(path), SCHEMA)) == [(1, "x\ny", "z")]
    other = tmp_path / "other"
    written(other, [(7, "p", "q\nr")], header=False)
    assert rows_of(CS.read_csv_split(spark, str(other), SCHEMA, header=False)) == [(7, "p", "q\nr")]


def test_unclosed_quote_is_quarantined_not_gathered(spark, tmp_path, block):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text("id,a,b\n1,x,y\nbad,x,y\n2,\"open,y\n" + "3,x,y\n" * 50)
    block(60)
    got = CS.read_csv_split(spark, str(path), SCHEMA, mode="PERMISSIVE", most_lines=20)
    good, bad = T.split_quarantine(got)
    assert rows_of(good) == [(1, "x", "y")]
    assert sorted(r[0] for r in bad.collect()) == sorted(["bad,x,y", '2,"open,y'] + ["3,x,y"] * 50)
    with pytest.raises(Exception):
        CS.read_csv_split(spark, str(path), SCHEMA, most_lines=20).collect()


def test_small_block_table_is_not_shuffled_against(spark, tmp_path):
    """Lines meet the one row of their block in a broadcast join, while that table is small."""
    path = written(tmp_path / "csv", [(1, "a\nb", "c"), (2, "d", "e")])
    records, _ = CS.csv_records(spark, path)
    assert sorted((r["n_lines"], r["record"]) for r in records.collect()) == [(1, "2,d,e"), (2, '1,"a\nb",c')]
    whole = records._jdf.queryExecution().executedPlan().toString().split("left_anti")[0]
    assert "BroadcastHashJoin" in whole


def test_records_are_put_together_where_they_are_read(spark, tmp_path, block):
    """Only records cut by the end of a block or batch are grouped; one by one or all at once is the same."""
    rows = [(i, "\n".join(["x"] * (i % 7 + 1)), f"b{i}") for i in range(100)]
    path = written(tmp_path / "csv", rows)
    block(1 << 20)
    lines = CS.numbered_lines(spark, path)
    found = CS._record(lines, CS.block_starts(lines)).mapInArrow(CS._pieces, CS.PIECES)
    assert lines.count() > 350 and 101 <= found.count() <= 130 and found.where("whole").count() >= 80       # the header too
    block(1500)
    for batch in ("3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            assert rows_of(CS.read_csv_split(spark, path, SCHEMA)) == sorted(rows, key=repr)
            _, long = CS.csv_records(spark, path, most_lines=6)
            assert sorted((r["n_lines"], r["value"]) for r in long.collect()) == sorted(
                (7, v) for i, a, b in rows if i % 7 == 6 for v in f'{i},"{a}",{b}'.split("\n"))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
