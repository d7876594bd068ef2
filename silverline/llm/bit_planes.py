"""Hard-negative mining with exact scores by the method of the Four Russians.

Vectors become integers, floor(256 x). Candidates are packed, some thousands to
a cell: one bit plane for every bit of the two's complement of a component, and
eight components of a plane in one byte. For every eight dimensions an anchor
has a table of the 256 sums of subsets of its components. A candidate's plane is
worth the sum of the tables' entries at its bytes; shifting the planes' worths
together, the sign's plane counted negative, gives the whole inner product. It
is exact and needs no multiplication.

Cells and blocks of anchors are two small tables. Every block of anchors goes to
every lane of cells (an equi-join on the lane), so each anchor meets each row
once, no task holds more than the few cells of a lane and one block, and only the
best few of an anchor in a cell leave a task. Blocks are many times more rows once
they are sent to the lanes, which Spark's estimate of their size does not see: the
join is a sorted one, so that neither side is gathered on the driver. Cells hold a fixed number of rows as they come,
so neither a hot label nor a hot id makes one larger. A first pass finds an
anchor's positives among rows of its label, a second one the negatives under
each positive's score.

Defined cases: rows without vec_id, label or vector, or with a component that is
null, NaN or infinite take no part. Shorter vectors (empty ones too) count as
padded with zeros. An anchor's own id is never its candidate. Rows that repeat an
anchor, or a candidate's id and score, count once. An anchor without positives
or negatives has no row; an empty table gives none. Scores that could outgrow a
long raise an error instead of wrapping. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from silverline.catalog import stored
from silverline.llm.frames import only, rows_in

SCALE = 256
EVERY = 100             # ids divisible by it are anchors
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100     # least score of a negative, in HIGH-ths of the positive's
CELL = 8_192            # candidates packed together
BLOCK = 128             # anchors
CHUNK = 1_024           # candidates scored at once
LANES, LANE_CELLS = 256, 16     # a cell has a lane of its own up to so many, then so many cells share one
_LIMIT = 1 << 62

CELLS = "ids binary, labels binary, dims int, bits int, planes binary"
BLOCKS = "keys binary, ids binary, labels binary, dims int, vectors binary, wanted array<array<bigint>>"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part; every seventh id has the next label."""
    rows = only(embeddings, "vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    label = F.col("label").cast("bigint")
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("vector"))


def integers(vectors: pa.Array) -> np.ndarray:
    """(rows, widest) array of floor(256 x), padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(x) and np.abs(x).max() >= _LIMIT:
        raise ValueError("a component is too large for exact scores")
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = x.astype(np.int64)
    return out


# ---------------------------------------------------------------- the method

def bit_planes(q: np.ndarray) -> np.ndarray:
    """(bits, groups of eight dimensions, rows) bytes of the two's complement."""
    low, high = int(q.min(initial=0)), int(q.max(initial=0))
    bits = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    wide = np.zeros((len(q), -(-q.shape[1] // 8) * 8), np.int64)
    wide[:, :q.shape[1]] = q
    return np.stack([np.packbits((wide >> b & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)])


def subset_sums(q: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """(groups, 256, anchors): sums of the components whose bits are set in the index."""
    groups = -(-q.shape[1] // 8)
    wide = np.zeros((len(q), groups * 8), kind)
    wide[:, :q.shape[1]] = q
    tables = np.zeros((groups, 1, len(q)), kind)
    for k in range(8):
        tables = np.concatenate([tables, tables + wide[:, k::8].T[:, None, :]], axis=1)
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products, by shifting and adding looked-up sums."""
    out = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    found = np.empty_like(out)
    top = len(planes) - 1
    for b in range(top, -1, -1):
        out <<= 1
        for table, bytes_ in zip(tables, planes[b]):
            np.take(table, bytes_, axis=0, out=found, mode="clip")
            if b == top:
                out -= found
            else:
                out += found
    return out


# ---------------------------------------------------------------- packing

def _pack_cells(size: int) -> Callable:
    names = [c.split()[0] for c in CELLS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _pieces(batches, size):
            q = integers(table["vector"])
            labels = table["label"].to_numpy()
            order = np.argsort(labels, kind="stable")
            planes = bit_planes(q[order])
            yield pa.RecordBatch.from_arrays([
                pa.array([table["vec_id"].to_numpy()[order].tobytes()], pa.binary()), pa.array([labels[order].tobytes()], pa.binary()),
                pa.array([q.shape[1]], pa.int32()), pa.array([len(planes)], pa.int32()), pa.array([planes.tobytes()], pa.binary())], names)
    return run


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of `size` rows, the last one smaller."""
    held, n = [], 0
    for batch in rows_in(batches):
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size - n)
            held.append(part)
            n, at = n + part.num_rows, at + part.num_rows
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _pack_blocks(size: int) -> Callable:
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _pieces(batches, size):
            q = integers(table["vector"])
            yield pa.RecordBatch.from_arrays([
                *[pa.array([table[c].to_numpy().tobytes()], pa.binary()) for c in ("key", "vec_id", "label")],
                pa.array([q.shape[1]], pa.int32()), pa.array([q.tobytes()], pa.binary()),
                pa.array([table["wanted"].to_pylist()], pa.list_(pa.list_(pa.int64())))], names)
    return run


def cells(rows: DataFrame, size: int = CELL) -> tuple[DataFrame, int]:
    """The packed candidates with the lane each is met in, and the number of lanes."""
    packed = stored(rows.select("vec_id", "label", "vector").mapInArrow(_pack_cells(size), CELLS), "cells")
    n = packed.count()
    lanes = max(min(n, LANES), -(-n // LANE_CELLS), 1)
    return packed.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes))), lanes


def _met(anchors: DataFrame, packed: DataFrame, lanes: int, block: int) -> DataFrame:
    """Every block of anchors beside every cell."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    blocks = anchors.select("key", "vec_id", "label", "vector", "wanted").mapInArrow(_pack_blocks(block), BLOCKS)
    blocks = stored(blocks, "anchor-blocks").select(*[F.col(c).alias(f"a_{c}") for c in names])
    sent = blocks.withColumn("a_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    # as many tasks as lanes, whatever their bytes: the work is in the pairs. Blocks stream past the cells of their lane, which are held.
    return (sent.repartition(lanes, "a_lane").join(packed.repartition(lanes, "lane").hint("merge"), F.col("lane") == F.col("a_lane"))
            .drop("lane", "a_lane"))


# ---------------------------------------------------------------- scoring

FOUND = "key bigint, bound bigint, vec_id bigint, score bigint"


def _best(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Indices of the first `most` distinct (score, id), by score from above and id from below."""
    some = 8 * most
    while True:                                 # more of them, where copies hide others
        at = np.arange(len(score))
        if some < len(score):
            at = np.flatnonzero(score >= np.partition(score, len(score) - some)[len(score) - some])
        order = at[np.lexsort((ids[at], -score[at]))]
        new = np.ones(len(order), bool)
        new[1:] = (ids[order[1:]] != ids[order[:-1]]) | (score[order[1:]] != score[order[:-1]])
        if new.sum() >= most or len(at) == len(score):
            return order[new][:most]
        some *= 8


@dataclass
class _Meeting:
    """One cell and one block of anchors."""
    ids: np.ndarray             # candidates, sorted by label
    labels: np.ndarray
    planes: np.ndarray
    keys: np.ndarray            # anchors
    own: np.ndarray
    wants: np.ndarray
    tables: np.ndarray
    wanted: list

    @classmethod
    def of(cls, row: dict) -> "_Meeting":
        def longs(name: str) -> np.ndarray:
            return np.frombuffer(row[name], np.int64)
        ids, keys = longs("ids"), longs("a_keys")
        planes = np.frombuffer(row["planes"], np.uint8).reshape(row["bits"], -1, len(ids))
        q = longs("a_vectors").reshape(len(keys), row["a_dims"])
        most = int(np.abs(q).sum(axis=1).max(initial=0)) << len(planes)     # of any sum on the way
        if most >= _LIMIT:
            raise ValueError("scores may outgrow a long")
        tables = subset_sums(q, np.int32 if most < 1 << 30 else np.int64)
        groups = min(len(tables), planes.shape[1])                          # beyond, one side is zero
        return cls(ids, longs("labels"), planes[:, :groups], keys, longs("a_ids"), longs("a_labels"), tables[:groups], row["a_wanted"])

    def scores(self, anchors: np.ndarray | slice, low: int, high: int) -> np.ndarray:
        """(anchors, high - low) scores."""
        tables = np.ascontiguousarray(self.tables[:, :, anchors])
        parts = [scores(tables, self.planes[:, :, at:min(at + CHUNK, high)]).T for at in range(low, high, CHUNK)]
        return np.concatenate(parts, axis=1).astype(np.int64) if parts else np.zeros((tables.shape[2], 0), np.int64)

    def same_label(self, most: int) -> Iterator[tuple]:
        """key, None, ids and scores of the best rows of each anchor's label."""
        for label in np.unique(self.wants):
            mine = np.flatnonzero(self.wants == label)
            low, high = np.searchsorted(self.labels, [label, label + 1])
            for j, row in zip(mine, self.scores(mine, low, high)):
                others = np.flatnonzero(self.ids[low:high] != self.own[j])
                best = others[_best(row[others], self.ids[low:high][others], most)]
                yield self.keys[j], None, self.ids[low:high][best], row[best]

    def other_labels(self, most: int) -> Iterator[tuple]:
        """key, bound, ids and scores of the best rows of other labels under each wanted score of an anchor."""
        for j, row in enumerate(self.scores(slice(None), 0, len(self.ids))):
            other = (self.labels != self.wants[j]) & (self.ids != self.own[j])
            for bound in self.wanted[j]:
                fit = np.flatnonzero(other & (row <= bound) & (HIGH * row >= LOW * bound))
                best = fit[_best(row[fit], self.ids[fit], most)]
                yield self.keys[j], bound, self.ids[best], row[best]


def _mined(method: Callable, most: int) -> Callable:
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            for i in range(batch.num_rows):
                columns: list[list] = [[], [], [], []]
                for key, bound, ids, score in method(_Meeting.of({c: batch.column(c)[i].as_py() for c in batch.schema.names}), most):
                    for column, values in zip(columns, ([int(key)] * len(ids), [bound] * len(ids), ids.tolist(), score.tolist())):
                        column += values
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
    return run


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first `most` rows of an anchor and bound over all cells, with their rank."""
    order = Window.partitionBy("key", "bound").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= most).dropDuplicates(["key", "bound", "rank"])


def hard_negatives(embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = usable(embeddings)
    packed, lanes = cells(rows, cell)
    anchors = stored(rows.where(F.col("vec_id") % every == 0).distinct()
                     .withColumn("key", F.xxhash64("vec_id", "label", "vector")), "anchors")
    none = F.lit(None).cast("array<bigint>")
    first = _met(anchors.withColumn("wanted", none), packed, lanes, block).mapInArrow(_mined(_Meeting.same_label, positives), FOUND)
    near = stored(_first(first, positives).select("key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    bounds = near.groupBy("key").agg(F.collect_set("positive_score").alias("wanted"))
    second = _met(anchors.join(bounds.hint("merge"), "key"), packed, lanes, block).mapInArrow(_mined(_Meeting.other_labels, negatives), FOUND)
    below = _first(second, negatives).select("key", F.col("bound").alias("positive_score"), "rank",
                                             F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    return (near.hint("merge").join(below, ["key", "positive_score"]).join(named.hint("merge"), "key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    return hard_negatives(Tables(spark, sf_dir).embeddings)


ORACLE = f"""
WITH rows_in AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows_in a JOIN rows_in r ON a.vec_id <> r.vec_id WHERE a.vec_id % {EVERY} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT same
   AND {LOW} * positive_score <= {HIGH} * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {NEGATIVES}
"""
