"""Line dedup across documents, returning keep bitmaps instead of text.

Every line's key is its text without the white space around it, A-Z lower-cased.
Keys of at least LEAST_CHARS code points that are found in LEAST_DOCS documents
or more lose all their lines, except in the largest doc_id that holds them.

A document sends one row for each of its long keys: a 128-bit hash and the
places of its lines. Rows are partitioned by ranges of (hash, doc_id) and sorted
by hash, largest document first, so a partition is streamed once: the first
document of a key keeps its lines, the others are held until LEAST_DOCS
documents have been seen (at most that many documents' rows) and then told apart
at once. The document is part of the range, so a key that a third of all
documents hold is cut over many partitions. Only a partition's first and last
key can reach into another one: their rows go out undecided with the first
LEAST_DOCS documents of the piece, and are decided by joining the union of the
pieces, at most two keys a partition.

Dropped places are folded to a bitmap a document, packed and deflated. Documents
are told apart by doc_id and a hash of their text.

Defined cases: a null or empty text is one empty line; all of a key's lines in
one document count as that document once; rows that share a doc_id are one
document when documents are counted, and their lines are decided alike; rows
without doc_id are one document, below every id. A line may be as long as its
text. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import stored
from silverline.llm import flat_text as ft
from silverline.llm.frames import only, rows_in

LEAST_CHARS, LEAST_DOCS = 40, 5

KEYED = "hi bigint, lo bigint, doc_id bigint, digest bigint, n_lines int, places binary"
JUDGED = KEYED + ", open boolean, docs array<bigint>"
BITMAPS = "doc_id bigint, digest bigint, n_lines bigint, n_dropped bigint, keep binary"
_JUDGED = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("n_lines", pa.int32()),
                     ("places", pa.binary()), ("open", pa.bool_()), ("docs", pa.list_(pa.int64()))])


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """Key of a line, if it is long enough (bytes.strip and bytes.lower are ASCII only)."""
    if len(line) < least_chars:
        return None
    key = line.strip().lower()
    if len(key) < least_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return key


def _keys(least_chars: int) -> Callable:
    names = [c.split()[0] for c in KEYED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            ids, digests, seen = batch.column(0).to_pylist(), batch.column(1).to_pylist(), set()
            for low, high, data, offsets in ft.blocks(batch.column(2)):
                hashes, rows, places = [], [], []
                for k in range(low, high):
                    if (ids[k], digests[k]) in seen:        # a repeated row adds nothing
                        continue
                    seen.add((ids[k], digests[k]))
                    lines = data[offsets[k - low]:offsets[k - low + 1]].tobytes().split(b"\n")
                    found: dict[bytes, list[int]] = {}
                    for at, line in enumerate(lines):
                        if (key := line_key(line, least_chars)) is not None:
                            found.setdefault(key, []).append(at)
                    hashes += [hashlib.blake2b(key, digest_size=16).digest() for key in found]
                    rows += [(ids[k], digests[k], len(lines))] * len(found)
                    places += [np.array(at, np.int32).tobytes() for at in found.values()]
                both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int32()), pa.array(places, pa.binary())], names)
    return run


class _Piece:
    """The rows of one key in one partition."""

    def __init__(self, key: tuple, first: bool, least_docs: int):
        self.key, self.open, self.least = key, first, least_docs
        self.docs: list[int | None] = []
        self.pending: list[pa.RecordBatch] = []

    def _out(self, rows: pa.RecordBatch, open_: bool) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array([open_] * n, pa.bool_()), pa.nulls(n, pa.list_(pa.int64()))], schema=_JUDGED)

    def _others(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """Rows of all documents but the first."""
        return self._out(rows.filter(pc.fill_null(pc.not_equal(rows.column("doc_id"), self.docs[0]), True)), False)

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if len(self.docs) < self.least:
            self.docs += [d for d in pc.unique(rows.column("doc_id")).slice(0, self.least + 1).to_pylist() if d not in self.docs]
            self.docs = self.docs[:self.least]
        if self.open:
            yield self._out(rows, True)
        elif len(self.docs) < self.least:
            self.pending.append(rows)
        else:
            yield from map(self._others, self.pending)
            self.pending = []
            yield self._others(rows)

    def close(self, last: bool) -> Iterator[pa.RecordBatch]:
        if last:
            yield from (self._out(rows, True) for rows in self.pending)
        if last or self.open:
            yield pa.RecordBatch.from_arrays([
                pa.array([self.key[0]]), pa.array([self.key[1]]), *[pa.nulls(1, _JUDGED.field(c).type) for c in ("doc_id", "digest", "n_lines", "places")],
                pa.array([True]), pa.array([self.docs], pa.list_(pa.int64()))], schema=_JUDGED)


def _judge(least_docs: int) -> Callable:
    """Streams a sorted partition: rows to drop, undecided rows, and the documents of undecided keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = None
        for batch in rows_in(batches):
            hi, lo = batch.column("hi").to_numpy(), batch.column("lo").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]), [True]]))
            some = np.diff(edge) >= least_docs          # keys inside the batch with fewer rows stay
            some[0] = some[-1] = True
            for k in np.flatnonzero(some):
                low, high = int(edge[k]), int(edge[k + 1])
                key = int(hi[low]), int(lo[low])
                if piece is None or piece.key != key:
                    if piece is not None:
                        yield from piece.close(last=False)
                    piece = _Piece(key, piece is None, least_docs)
                yield from piece.add(batch.slice(low, high - low))
        if piece is not None:
            yield from piece.close(last=True)
    return run


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One deflated bitmap a document: bit k is set where line k stays."""
    names = [c.split()[0] for c in BITMAPS.split(", ")]
    for batch in rows_in(batches):
        dropped, keep = [], []
        for n, places in zip(batch.column("n_lines").to_pylist(), batch.column("places").to_pylist()):
            stays = np.ones(n, bool)
            stays[np.frombuffer(b"".join(places), np.int32)] = False
            dropped.append(int(n - stays.sum()))
            keep.append(zlib.compress(np.packbits(stays).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), batch.column("n_lines").cast(pa.int64()),
                                          pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())], names)


def _texts(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("digest"), "text")


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, digest (of the text), n_lines, n_dropped, keep of the documents that lose a line."""
    keyed = stored(_texts(docs).mapInArrow(_keys(least_chars), KEYED), "line-keys")
    order = [F.col("hi"), F.col("lo"), F.col("doc_id").desc_nulls_last(), F.col("digest")]
    judged = stored(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_judge(least_docs), JUDGED), "line-verdicts")
    lost = judged.where("docs IS NULL")
    # at most the first and the last key of each partition
    common = (judged.where("docs IS NOT NULL").groupBy("hi", "lo").agg(F.array_distinct(F.flatten(F.collect_list("docs"))).alias("found"))
              .where(F.size("found") >= least_docs).select("hi", "lo", F.array_max("found").alias("largest")))
    decided = lost.where("open").join(F.broadcast(common), ["hi", "lo"]).where(~F.col("doc_id").eqNullSafe(F.col("largest")))
    columns = "doc_id", "digest", "n_lines", "places"
    per = lost.where("NOT open").select(*columns).unionByName(decided.select(*columns)).groupBy("doc_id", "digest").agg(
        F.first("n_lines").alias("n_lines"), F.collect_set("places").alias("places"))
    return per.mapInArrow(_fold, BITMAPS)


def stays(keep: bytes | None, n: int) -> np.ndarray:
    """The bits of a bitmap; without one all lines stay."""
    return np.ones(n, bool) if keep is None else np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n).astype(bool)


def _kept(make: Callable[[bytes], object], kind: pa.DataType, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            ids, keeps = batch.column("doc_id"), batch.column("keep").to_pylist()
            for low, high, data, offsets in ft.blocks(batch.column("text")):
                n, dropped, kept = [], [], []
                for k in range(low, high):
                    raw = data[offsets[k - low]:offsets[k - low + 1]].tobytes()
                    n.append(raw.count(b"\n") + 1)
                    dropped.append(0)
                    if keeps[k] is not None:
                        bits = stays(keeps[k], n[-1])
                        dropped[-1] = int(n[-1] - bits.sum())
                        raw = b"\n".join(line for line, bit in zip(raw.split(b"\n"), bits) if bit)
                    kept.append(make(raw))
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                                                  pa.array(kept, kind)], ["doc_id", "n_lines", "n_dropped", name])
    return run


def _applied(docs: DataFrame, bitmaps: DataFrame, made: Callable, name: str) -> DataFrame:
    b = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("digest").alias("b_digest"), "keep")
    same: Column = F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("digest") == F.col("b_digest"))
    return _texts(docs).join(b, same, "left").select("doc_id", "text", "keep").mapInArrow(
        made, f"doc_id bigint, n_lines bigint, n_dropped bigint, {name} string")


def kept_texts(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay) of every row of docs."""
    return _applied(docs, bitmaps, _kept(lambda raw: raw.decode("utf-8", "replace"), pa.string(), "text"), "text")


def kept_digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row of docs."""
    return _applied(docs, bitmaps, _kept(lambda raw: hashlib.sha256(raw).hexdigest(), pa.string(), "kept_sha256"), "kept_sha256")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    docs = Tables(spark, sf_dir).documents
    return kept_digests(docs, keep_bitmaps(docs))


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= {LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
told AS (SELECT k.doc_id, k.line, k.place, c.key IS NOT NULL AND k.doc_id <> c.largest AS gone FROM keyed k LEFT JOIN common c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""
