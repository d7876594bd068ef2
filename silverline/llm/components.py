"""Connected components of an edge table by distributed union-find.

Each partition first runs union-find over its own edges and keeps only a
spanning star per local set (path halving, smaller root wins). The remaining
edges are contracted by alternating star steps: every node re-hangs its larger
neighbours, then itself, below the smallest node it knows, and each partition
contracts the result once more, until the edges are stars: a node hangs below
one smaller node, or others hang below it, never both. One aggregation sees
that, so no round is made only to find that nothing changes. Labels are the
smallest node of the component.

All steps are aggregations and joins on a node, with partial aggregation before
the shuffle, so a node with very many edges is never gathered in one task, and
each round is written to the shared folder, so a lost executor does not reach
back through earlier rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverline.catalog import stored
from silverline.llm.frames import rows_in

EDGE = "u bigint, v bigint"


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in(batches):
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent.setdefault(parent[x], parent[x])
                x = parent[x]
            return x

        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(x, r) for x in list(parent) if (r := find(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                          pa.array([p[1] for p in pairs], pa.int64())], ["u", "v"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(e: DataFrame) -> bool:
    """No node has two nodes above it, or nodes on both sides."""
    node = e.select(F.col("u").alias("node"), F.col("v").alias("above")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(None).cast("bigint").alias("above")))
    per = node.groupBy("node").agg(F.min("above").alias("low"), F.max("above").alias("high"),
                                   F.count_if(F.col("above").isNull()).alias("below"))
    return per.where("low < high OR (low IS NOT NULL AND below > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge in `edges` (u, v: bigint)."""
    e = stored(edges.select("u", "v").where("u <> v").mapInArrow(_local, EDGE), "cc-0")
    k = 0
    while not _are_stars(e):
        k += 1
        e = stored(_small_star(_large_star(e)).mapInArrow(_local, EDGE), f"cc-{k}")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
