"""Fault injection with literal rows (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from silverline.functions import scalars as S
from silverline.operators import quality as Q
from silverline.operators import windows as W
from silverline.operators.dedupe import latest_per_key
from silverline.operators import versioned as V
from silverline.sources import text as T


def _write_lines(path, lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def test_quote_inside_csv_field(spark, tmp_path):
    f = _write_lines(tmp_path / "q.csv", ["id,name,note", '2,al,"x ""q"" y, z"'])
    df = T.read_csv_typed(spark, f, "id int, name string, note string")
    assert df.collect()[0]["note"] == 'x "q" y, z'


def test_newline_inside_csv_field_is_one_record(spark, tmp_path):
    f = _write_lines(tmp_path / "n.csv", ["id,name,address", '1,bob,"1 A St', 'Town, KY 01352"'])
    rows = T.read_csv_typed(spark, f, "id int, name string, address string").collect()
    assert len(rows) == 1 and rows[0]["address"] == "1 A St\nTown, KY 01352"


def test_wrong_arity_is_quarantined(spark):
    lines = spark.createDataFrame([("a,b,2020-01-01,3,tea",), ("a,b,2020-01-01,3,tea,extra",)], "value string")
    schema = T.string_schema(["uuid", "user_uuid", "date", "quantity", "product"])
    good, bad = T.split_quarantine(T.parse_delimited(lines, schema))
    assert good.count() == 1
    assert [r[0] for r in bad.collect()] == ["a,b,2020-01-01,3,tea,extra"]


def _parsed(spark, address):
    df = spark.createDataFrame([(address,)], "address string")
    l2 = S.address_line("address", 2)
    return df.select(S.address_line("address", 1).alias("street"), S.city_of(l2).alias("city"),
                     S.state_of(l2).alias("state"), S.zip_of(l2).alias("zip")).collect()[0]


def test_one_line_address(spark):
    r = _parsed(spark, "1 A St")
    assert (r.street, r.city, r.state, r.zip) == ("1 A St", None, None, None)


def test_military_address(spark):
    r = _parsed(spark, "Unit 6184 Box 9593\nDPO AP 09617")
    assert (r.city, r.state, r.zip) == (None, "AP", "09617")


def test_tie_on_timestamp_same_winner_any_partitioning(spark):
    ts = dt.datetime(2020, 1, 1, 10)
    rows = [(1, ts, 7, 3.0, 2), (1, ts, 5, 9.0, 4), (1, ts, 5, 1.0, 8), (2, ts, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, p long, price double, q int")
    order = [("ts", "desc"), ("p", "asc"), ("price", "asc"), ("q", "asc")]
    results = set()
    for n in (1, 3, 7):
        for method in ("aggregate", "window"):
            out = latest_per_key(df.repartition(n), ["k"], order, method=method).orderBy("k").collect()
            results.add(tuple(tuple(r) for r in out))
    assert len(results) == 1
    winner = [r for r in next(iter(results)) if r[0] == 1][0]
    assert winner[2:] == (5, 1.0, 8)


def test_older_and_equal_copy_replayed(spark):
    new, old = dt.datetime(2020, 1, 2), dt.datetime(2019, 1, 1)
    base = spark.createDataFrame([(1, new, 3), (2, new, 4)], "k long, ts timestamp_ntz, q int")
    replay = spark.createDataFrame([(1, old, 3), (1, new, 3)], "k long, ts timestamp_ntz, q int")
    out = latest_per_key(base.unionByName(replay), ["k"], [("ts", "desc"), ("q", "asc")])
    assert out.count() == base.count()
    assert out.filter("k = 1").collect()[0]["ts"] == new


def test_unknown_parent_is_one_orphan(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    orders = spark.createDataFrame([(10, 1), (11, 2), (12, 999)], "order_id long, user_id long")
    rule = Q.relationships(orders, "user_id", users, "user_id", "order_id")
    assert [r.order_id for r in rule.violations().collect()] == [12]


def test_null_in_accepted_values_column(spark):
    df = spark.createDataFrame([(1, "bread"), (2, None)], "order_id long, product string")
    accepted = Q.accepted_values(df, "product", ["bread"], "order_id")
    not_null = Q.not_null(df, "product", "order_id")
    report = {r.rule: (r.failures, r.status) for r in Q.run_checks([accepted, not_null]).collect()}
    assert report["accepted_values_product"] == (0, "PASS")
    assert report["not_null_product"] == (1, "ERROR")


def test_warn_severity(spark):
    df = spark.createDataFrame([(1, -1)], "order_id long, quantity int")
    rule = Q.expression(df, "positive", F.col("quantity") <= 0, "order_id", severity="warn")
    assert Q.run_checks([rule]).collect()[0]["status"] == "WARN"


def test_user_without_orders_birthdate_flag(spark):
    from silverline.plans import silver

    users = spark.createDataFrame(
        [(1, "a", "A", "M", "1 St\nX, AL 00001", "a@x", dt.date(1990, 1, 1)),
         (2, "b", "B", "F", "2 St\nY, AK 00002", "b@x", None)],
        "uuid long, username string, name string, sex string, address string, mail string, birthdate date")
    orders = spark.createDataFrame([], "order_id long, user_id long, ordered_at timestamp_ntz, quantity int, product string")
    out = {r.user_id: r.birthdate_is_valid for r in silver.stg_users(users, orders).collect()}
    assert out == {1: True, 2: False}


def test_previous_zero_gives_null_change(spark):
    df = spark.createDataFrame([("p", 1, 0), ("p", 2, 5)], "product string, m int, quantity long")
    rows = W.change_vs_previous(df, ["product"], "m", "quantity").orderBy("m").collect()
    assert rows[1]["previous_quantity"] == 0 and rows[1]["mom_pct"] is None


def test_earlier_state_after_append(spark, tmp_path):
    base = spark.createDataFrame([(i, i * 2) for i in range(10)], "id long, v long")
    root = str(tmp_path / "t")
    V.write_batch(base, root, 1)
    V.write_batch(spark.createDataFrame([(100, 1)], "id long, v long"), root, 2)
    assert V.read_batches(spark, root).count() == 11
    before = V.read_batches(spark, root, upto=1)
    assert before.exceptAll(base).count() == 0 and base.exceptAll(before).count() == 0
    assert V.with_null_column(before, "source", "string").filter(F.col("source").isNotNull()).count() == 0
