"""Property tests: Spark operators against brute force on random small inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from silverline.operators import reconcile as R
from silverline.operators.dedupe import latest_per_key

ROWS = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 2), st.integers(0, 9)),
    min_size=0, max_size=40,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_latest(rows):
    """Per key: max ts, then min tie, then min payload (the declared order)."""
    best = {}
    for k, ts, tie, payload in rows:
        rank = (ts, -tie, -payload)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, ts, tie, payload))
    return sorted(v[1] for v in best.values())


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_latest_per_key_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, ts int, tie int, payload int").repartition(parts)
    order = [("ts", "desc"), ("tie", "asc"), ("payload", "asc")]
    want = brute_latest(rows)
    for method in ("aggregate", "window"):
        got = sorted(tuple(r) for r in latest_per_key(df, ["k"], order, method=method).collect())
        assert got == want


@SETTINGS
@given(left=ROWS, right=ROWS)
def test_diff_rows_matches_counter_difference(spark, left, right):
    schema = "a int, b int, c int, d int"
    l_df, r_df = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    cl, cr = Counter(left), Counter(right)
    want = sorted([(*row, "left_only") for row in (cl - cr).elements()]
                  + [(*row, "right_only") for row in (cr - cl).elements()])
    got = sorted(tuple(r) for r in R.diff_rows(l_df, r_df).collect())
    assert got == want
    count = R.different_row_count(l_df, r_df, "m").collect()[0]["different_rows"]
    assert count == len(want)
