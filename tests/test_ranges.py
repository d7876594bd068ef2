"""Byte verification by ranges."""

import random

import pytest

from silverline.sources import ranges as R


@pytest.fixture
def folders(tmp_path):
    rng = random.Random(9)
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    for k in range(2):
        data = "\n".join("x" * rng.randrange(60) + rng.choice(["", "é", "\r"]) for _ in range(300)).encode() + b"\n"
        (a / f"f{k}.csv").write_bytes(data)
        (b / f"f{k}.csv").write_bytes(data)
    return a, b


def found(spark, a, b, size=500):
    return {(r["file"], r["start"]): r["status"] for r in R.verify_ranges(spark, str(a), str(b), size).collect() if r["status"] != "equal"}


def test_equal_folders(spark, folders):
    a, b = folders
    every = R.verify_ranges(spark, str(a), str(b), 500).collect()
    assert {r["status"] for r in every} == {"equal"} and sum(r["lines"] for r in every) == 600 and len(every) > 20


def test_one_altered_byte_is_reported_with_its_range(spark, folders):
    a, b = folders
    data = bytearray((b / "f1.csv").read_bytes())
    line = data.rindex(b"\n", 0, 4000) + 1              # first byte of a line
    data[line] = ord("y") if data[line] != 10 else 10
    at = next(k for k in range(line, len(data)) if data[k] not in (10, 13, 195, 169))
    data[at] = ord("z")
    (b / "f1.csv").write_bytes(bytes(data))
    begins = data.rindex(b"\n", 0, at) + 1
    assert found(spark, a, b) == {("f1.csv", begins // 500 * 500): "differs"}


def test_lost_and_extra_parts(spark, folders):
    a, b = folders
    (a / "only.csv").write_text("a\n")
    data = (b / "f0.csv").read_bytes()
    (b / "f0.csv").write_bytes(data[:-1])               # the last line end
    assert set(found(spark, a, b).values()) == {"differs", "left_only"}
    (b / "f0.csv").write_bytes(data + b"more\n" * 200)
    got = found(spark, a, b)
    assert "right_only" in got.values() and got[("only.csv", 0)] == "left_only"


def test_digests_do_not_depend_on_the_blocks(spark, folders):
    a, _ = folders
    whole = sorted(map(tuple, R.range_digests(R.line_places(spark, str(a), 500)).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        places = R.line_places(spark, str(a), 500)
        assert sorted(map(tuple, R.range_digests(places).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
