"""Benchmark decontamination by a distributed positional inverted index.

`build_index` stores token postings: the documents are cut into segments of
about a megabyte, and each segment keeps, per term, the ascending list of its
word positions (delta-coded), plus the word range of every document. Segments
are rows of a Parquet table in the shared folder, so the index is partitioned
by document, holds every document, and a lost executor re-reads its own rows.

The index holds the postings of all terms at every size. `decontaminate` cuts
the benchmark into windows in tasks too. A directory of the index (segment,
term, number of positions; terms of some window only) gives each window its
rarest term over all documents, and a join on that term sends the window to the
segments that hold it, so neither side is broadcast by this code and no
benchmark text reaches the driver. A window with a term that no document has
goes nowhere.

Within a segment the lists of a phrase are intersected from the rarest term on:
its positions, adjusted by the term's offset, are candidate starts, and each
further list (next rarest first) keeps those that it holds too. A phrase with a
term that the segment lacks costs one lookup. `search` takes a few given
phrases or proximity groups to all segments in the same way.

Defined cases: null and empty texts have no words (documents: zero hits;
items: no window). Repeated documents and repeated doc_ids are rows of their
own. Repeated item rows count once per item_id; null item_ids are skipped in
the id lists but their windows still mark hits. Empty tables give empty
(documents) or all-clean (benchmark) results. Other columns of the inputs are
ignored.
"""

from __future__ import annotations

import secrets
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.catalog import scratch_path, stored
from silverline.llm import flat_text as ft
from silverline.llm.frames import only, rows_in

SEGMENT_BYTES = 1 << 20
WINDOW = 10
# Windows of the benchmark in one Arrow batch.
WINDOW_ROWS = 10_000

SEGMENT_SCHEMA = ("segment bigint, doc_ids binary, null_ids binary, first binary, "
                  "terms binary, ptr binary, deltas binary")
DIRECTORY = "segment bigint, term bigint, n bigint"
WINDOWS = "terms array<bigint>, item_id bigint"
HIT_SCHEMA = ("segment bigint, ord int, doc_id bigint, n_words bigint, "
              "spans array<struct<lo:int,hi:int>>, item_ids array<bigint>")


# ---------------------------------------------------------------- index

def _packed(deltas: np.ndarray) -> bytes:
    """Byte planes of int32 values, compressed."""
    return pa.compress(np.ascontiguousarray(deltas.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def _segment(ids: pa.Array, w: ft.Words) -> tuple:
    h = ft.word_hashes(w)
    order = np.argsort(h, kind="stable")
    h, pos = h[order], order.astype(np.int32)
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    ptr = np.flatnonzero(new).astype(np.int32)
    deltas = np.diff(pos, prepend=np.int32(0)).astype(np.int32)
    deltas[ptr] = pos[ptr]
    return (secrets.randbits(63), ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
            np.asarray(ids.is_null()).astype(np.uint8).tobytes(), w.first.astype(np.int32).tobytes(),
            h[ptr].tobytes(), np.append(ptr, np.int32(len(h))).astype(np.int32).tobytes(), _packed(deltas))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]
    for batch in rows_in(batches):
        ids = batch.column(0).cast(pa.int64())
        for low, high, data, offsets in ft.blocks(batch.column(1), SEGMENT_BYTES):
            row = _segment(ids[low:high], ft.words_of(data, offsets, ft.ALNUM_LOWER))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64() if n == "segment" else pa.binary()) for n, v in zip(names, row)], names)


def build_index(docs: DataFrame) -> DataFrame:
    """Positional postings of all terms of (doc_id, text), stored in the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark, "positional-index")
    only(docs, "doc_id", "text").mapInArrow(_segments, SEGMENT_SCHEMA) \
        .write.option("compression", "zstd").parquet(path)
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each segment and how many positions they have."""
    for batch in rows_in(batches):
        for segment, terms, ptr in zip(*(batch.column(k) for k in range(3))):
            term = np.frombuffer(terms.as_py(), np.int64)
            n = np.diff(np.frombuffer(ptr.as_py(), np.int32)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(term), segment.as_py(), np.int64)), pa.array(term), pa.array(n)], ["segment", "term", "n"])


class Segment:
    """One row of the index, opened."""

    def __init__(self, row: dict):
        self.name = row["segment"]
        self.null = np.frombuffer(row["null_ids"], np.uint8)
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.first = np.frombuffer(row["first"], np.int32)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ptr = np.frombuffer(row["ptr"], np.int32)
        self.deltas = _unpacked(row["deltas"], int(self.ptr[-1]))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for terms that the segment lacks."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        slot = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[slot] == hashes, slot, -1)

    def positions(self, term: int) -> np.ndarray:
        return np.cumsum(self.deltas[self.ptr[term]:self.ptr[term + 1]])

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, pos, side="right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """First positions of the exact phrase, inside one document."""
        rarity = np.argsort(self.ptr[terms + 1] - self.ptr[terms], kind="stable")
        at = self.positions(terms[rarity[0]]) - rarity[0]
        for k in rarity[1:]:
            if not len(at):
                return at
            held = self.positions(terms[k]) - k
            slot = np.minimum(np.searchsorted(held, at), len(held) - 1)
            at = at[held[slot] == at]
        at = at[at >= 0]
        doc = self.doc_of(at)
        return at[(at + len(terms) <= self.first[doc + 1])]

    def near(self, terms: np.ndarray, slack: int) -> np.ndarray:
        """Positions of the rarest term that have every other term within
        `slack` words in the same document."""
        rarity = np.argsort(self.ptr[terms + 1] - self.ptr[terms], kind="stable")
        at = self.positions(terms[rarity[0]])
        for k in rarity[1:]:
            held = self.positions(terms[k])
            doc = self.doc_of(at)
            low = np.maximum(at - slack, self.first[doc])
            high = np.minimum(at + slack + 1, self.first[doc + 1])
            at = at[np.searchsorted(held, high) > np.searchsorted(held, low)]
        return at


# ---------------------------------------------------------------- search

def windows_of(items: list[tuple], size: int = WINDOW) -> dict[int, tuple[np.ndarray, list[set]]]:
    """Distinct windows of (item_id, text) rows by length: hashes (one row per
    window) and the item_ids that hold each. An item of fewer words than
    `size`, but not none, is one window."""
    found: dict[int, dict[bytes, set]] = defaultdict(dict)
    for item_id, text in items:
        data, offsets = ft.flatten(pa.array([text or ""], pa.large_string()))
        h = ft.word_hashes(ft.words_of(data, offsets, ft.ALNUM_LOWER))
        n = min(size, len(h))
        for i in range(len(h) - n + 1 if n else 0):
            found[n].setdefault(h[i:i + n].tobytes(), set()).add(item_id)
    return {n: (np.frombuffer(b"".join(w), np.uint64).reshape(-1, n), list(w.values())) for n, w in found.items()}


def _hits(seg: Segment, windows: dict, slack: int | None) -> pa.RecordBatch:
    """The rows of a segment's documents."""
    kind = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])
    n_docs = len(seg.ids)
    lo, hi, pairs = [], [], defaultdict(set)
    for n, (hashes, items) in windows.items():
        terms = seg.lookup(hashes)
        for k in np.flatnonzero((terms >= 0).all(axis=1)):
            at = seg.phrase(terms[k]) if slack is None else seg.near(np.unique(terms[k]), slack)
            if len(at):
                lo.append(at)
                hi.append(at + (n if slack is None else 1))
                for d in np.unique(seg.doc_of(at)):
                    pairs[int(d)].update(x for x in items[k] if x is not None)
    spans: list[list] = [[] for _ in range(n_docs)]
    if lo:
        cover = np.zeros(int(seg.first[-1]) + 1, np.int32)
        np.add.at(cover, np.concatenate(lo), 1)
        np.add.at(cover, np.concatenate(hi), -1)
        inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
        inside_doc = inside[1:-1]
        cut = np.zeros(len(inside_doc) + 1, bool)
        cut[seg.first] = True
        starts = np.flatnonzero(inside_doc & (~inside[:-2] | cut[:-1]))
        ends = np.flatnonzero(inside_doc & (~inside[2:] | cut[1:])) + 1
        for s, e, d in zip(starts, ends, seg.doc_of(starts)):
            base = seg.first[d]
            spans[d].append({"lo": int(s - base), "hi": int(e - base)})
    return pa.RecordBatch.from_arrays([
        pa.array([seg.name] * n_docs, pa.int64()), pa.array(np.arange(n_docs, dtype=np.int32)),
        pa.array(seg.ids, pa.int64(), mask=seg.null.astype(bool)), pa.array(np.diff(seg.first).astype(np.int64)),
        pa.array(spans, pa.list_(kind)),
        pa.array([sorted(pairs.get(d, ())) for d in range(n_docs)], pa.list_(pa.int64())),
    ], ["segment", "ord", "doc_id", "n_words", "spans", "item_ids"])


def search(index: DataFrame, windows: dict, slack: int | None = None) -> DataFrame:
    """One row per document: the word spans inside any occurrence, and the
    items found, of a few windows given by `windows_of`. `slack` None: exact
    phrases; else all terms of a window within `slack` words of its rarest one,
    in any order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            for i in range(batch.num_rows):
                yield _hits(Segment({n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}), windows, slack)

    return index.mapInArrow(run, HIT_SCHEMA)


def _windows(size: int, rows: int) -> Callable:
    """Windows of items, each with its item_id: an item of fewer words than `size`, but not none, is one."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            ids = batch.column(0).cast(pa.int64())
            for low, high, data, offsets in ft.blocks(batch.column(1)):
                w = ft.words_of(data, offsets, ft.ALNUM_LOWER)
                h = ft.word_hashes(w).view(np.int64)
                short = [(np.flatnonzero(w.per_doc == n), n) for n in range(1, size)]
                parts = [(*ft.window_starts(w.first, size), size), *((w.first[doc], doc, n) for doc, n in short)]
                for at, doc, n in parts:
                    for k in range(0, len(at), rows):
                        terms = h[at[k:k + rows, None] + np.arange(n)]
                        ends = np.arange(len(terms) + 1, dtype=np.int32) * n
                        yield pa.RecordBatch.from_arrays(
                            [pa.ListArray.from_arrays(ends, terms.ravel()), ids.take(pa.array(doc[k:k + rows] + low))], ["terms", "item_id"])

    return cut


def _candidates(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(segment, terms, item_id): the segments that hold a window's rarest term."""
    each = windows.select("terms").distinct().select("terms", F.explode("terms").alias("term"))
    listed = stored(index.select("segment", "terms", "ptr").mapInArrow(_listed, DIRECTORY)
                    .join(each.select("term").distinct(), "term", "left_semi"), "directory")
    total = listed.groupBy("term").agg(F.sum("n").alias("n"))
    rarest = (each.join(total, "term", "left").groupBy("terms")
              .agg(F.min_by("term", F.struct("n", "term")).alias("term"), F.count_if(F.col("n").isNull()).alias("lacking"))
              .where("lacking = 0").select("terms", "term"))
    return windows.join(rarest, "terms").join(listed, "term").select("segment", "terms", "item_id")


def _search_sent(slack: int | None) -> Callable:
    """Hits of a segment for the windows sent to it."""
    def run(segment: pa.Table, sent: pa.Table) -> pa.Table:
        by_size: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        for terms, item_id in zip(sent["terms"], sent["item_id"].to_pylist()):
            t = terms.values.to_numpy()
            by_size[len(t)][t.tobytes()].add(item_id)
        windows = {n: (np.frombuffer(b"".join(w), np.uint64).reshape(-1, n), list(w.values())) for n, w in by_size.items()}
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                            ("spans", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), ("item_ids", pa.list_(pa.int64()))])
        hits = [_hits(Segment(row), windows, slack) for row in segment.to_pylist()]
        return pa.Table.from_batches([x.select(schema.names).cast(schema) for x in hits], schema)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  block_words: int = WINDOW_ROWS, slack: int | None = None) -> DataFrame:
    """doc_id, n_words, spans (disjoint word ranges inside occurrences of a
    benchmark window) and item_ids (sorted) of every document row. Windows
    travel `block_words` at a time."""
    index = build_index(docs)
    items = only(benchmark, "item_id", "text").distinct()
    windows = stored(items.mapInArrow(_windows(size, block_words), WINDOWS).distinct(), "windows")
    sent = stored(_candidates(index, windows), "candidates")
    return index.groupBy("segment").cogroup(sent.groupBy("segment")).applyInArrow(
        _search_sent(slack), HIT_SCHEMA.removeprefix("segment bigint, ord int, "))


def digest(found: DataFrame) -> DataFrame:
    """The report columns of `decontaminate`'s rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + (x["hi"] - x["lo"]))
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE = r"""
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), dw AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low
), bw AS (
  SELECT DISTINCT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + least(10, len(w))], ' ') AS k, least(10, len(w)) AS n
  FROM (SELECT *, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM bw WHERE len(w) > 0)
), lens AS (
  SELECT DISTINCT n FROM win
), spot AS (
  SELECT row_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS k
  FROM (SELECT row_id, n, w, unnest(range(0, len(w) - n + 1)) AS i FROM dw, lens WHERE len(w) >= n)
), hit AS (
  SELECT s.row_id, s.i, s.n, win.item_id FROM spot s JOIN win ON s.n = win.n AND s.k = win.k
), covered AS (
  SELECT row_id, count(DISTINCT p) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY row_id
), items AS (
  SELECT row_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY row_id
)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered c USING (row_id) LEFT JOIN items i USING (row_id)
"""


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    t = Tables(spark, sf_dir)
    return digest(decontaminate(t.documents, t.benchmark))
