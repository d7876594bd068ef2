"""Near-duplicate detection: SuperMinHash, banding, verification, union-find.

A document is the set of its distinct 5-word shingles. SuperMinHash walks one
pseudo-random permutation of the M signature positions per element: at rank j
the element offers the value j + r (0 <= r < 1) to position p[j]. Positions are
correlated within an element, which lowers the variance of the estimate, and
the walk stops early: once every position holds a value below j, no later rank
can change the signature. Here all elements of a batch take rank j together, so
a document costs about 2 + M/n ranks instead of M hashes per element.

Exact copies collapse first: equal sets (128-bit digest) are one class, held by
its smallest doc_id. Classes are banded (32 bands of 4 values: two sets of
similarity 0.75 share no band with probability 5e-6). In each bucket the
members are compared with the bucket's smallest class, so a group of thousands
of near copies costs a pair per member, not all pairs. Members of buckets that
still hold several components are compared with a few further heads, drawn by
hash per bucket and round, as long as more pairs than that remain and the last
round left clearly fewer of them. What then remains is compared member by
member across components. Pairs are filtered
inside the joins by bounds that no link breaks: set sizes, the odd sketch (512
parities; its distance never exceeds the sets'), and a 256-bit sketch of the
signature at five standard deviations below similarity 0.75. Every
candidate is confirmed on the full shingle sets of the two whole texts.

Defined cases: null or word-less texts have the empty set and link with
nothing. A text of fewer than 5 words is one shingle, its whole sequence. Rows
that share a doc_id are one node. A row without doc_id never links; its
component is null and it is kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import stored
from silverline.llm import flat_text as ft
from silverline.llm.components import components
from silverline.llm.frames import only, rows_in

WORDS = 5
SIMILAR = 75          # percent
M, BANDS = 128, 32
ROWS = M // BANDS
CHUNK = 1 << 16       # elements ranked at a time
# Rounds against this many heads a bucket go on while more pairs than that remain per
# member, and each round leaves less than three quarters of them.
HEADS = 8
PAIRS_PER_MEMBER = 8
# Of the 128 two-bit cells, sets of similarity 0.75 agree in 104 on average
# (standard deviation 4.4).
SKETCH_AGREE = 82

SIGNATURE = ("doc_id bigint, n_shingles bigint, d0 bigint, d1 bigint, bands array<bigint>, "
             + ", ".join(f"s{k} bigint" for k in range(4)) + ", " + ", ".join(f"p{k} bigint" for k in range(8)))
_GOLD = 0x9E3779B97F4A7C15
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _step(k: int) -> np.uint64:
    return np.uint64(k * _GOLD & 0xFFFFFFFFFFFFFFFF)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) pairs, distinct, ordered by document and hash."""
    w = ft.words_of(data, offsets, ft.NOT_SPACE)
    h = ft.word_hashes(w)
    at, doc = ft.window_starts(w.first, size)
    out = ft.window_hash(h, at, size)
    for n in range(1, size):
        short = np.flatnonzero(w.per_doc == n)
        if len(short):
            out = np.concatenate([out, ft.window_hash(h, w.first[short], n)])
            doc = np.concatenate([doc, short])
    order = np.argsort(out)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(offsets) < 65536 else np.int64), kind="stable")]
    out, doc = out[order], doc[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return doc[fresh], out[fresh]


def superminhash(doc: np.ndarray, element: np.ndarray, n_docs: int, m: int = M) -> np.ndarray:
    """n_docs x m signatures (rank in the high 32 bits, r in the low ones) of
    (document, element) pairs ordered by document; empty documents hold all ones."""
    held = np.full((n_docs, m), _FULL)
    flat = held.reshape(-1)
    for low in range(0, len(doc), CHUNK):
        d, x = doc[low:low + CHUNK], element[low:low + CHUNK]
        p = np.broadcast_to(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(d), m)).copy()
        for j in range(m):
            if j:
                useful = (held[d[0]:d[-1] + 1].max(axis=1) >= np.uint64(j << 32))[d - d[0]]
                if not useful.all():
                    d, x, p = d[useful], x[useful], p[useful]
                if not len(d):
                    break
            z = ft.mix64(x + _step(j + 1))
            k = j + ((z >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
            rows = np.arange(len(d))
            pos = p[rows, k]
            p[rows, k] = p[:, j]
            np.minimum.at(flat, d * m + pos, (z & np.uint64(0xFFFFFFFF)) | np.uint64(j << 32))
    return held


def sketches(held: np.ndarray) -> np.ndarray:
    """Two bits of every signature value, packed to 64-bit words."""
    bits = ft.mix64(held.copy()) & np.uint64(3)
    shift = (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(bits.reshape(len(held), -1, 32) << shift, axis=2).view(np.int64)


def parities(doc: np.ndarray, element: np.ndarray, n_docs: int) -> np.ndarray:
    """Odd sketches: 512 cells that hold the parity of the elements hashed there.
    Two sets differ in at least as many elements as their sketches in cells."""
    cell = (ft.mix64(element ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(55)).astype(np.int64)
    odd = np.bincount(doc * 512 + cell, minlength=n_docs * 512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n_docs, 8)


def band_keys(held: np.ndarray) -> np.ndarray:
    out = np.zeros((len(held), BANDS), np.uint64)
    by_band = held.reshape(len(held), BANDS, ROWS)
    for r in range(ROWS):
        out += ft.mix64(by_band[:, :, r] + _step(r + 1)) * np.uint64(2 * r + 3)
    return ft.mix64(out + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_GOLD)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SIGNATURE.split(", ")]
    for batch in rows_in(batches):
        ids = batch.column(0)
        for low, high, data, offsets in ft.blocks(batch.column(1)):
            n = high - low
            doc, x = shingles(data, offsets)
            first = np.searchsorted(doc, np.arange(n + 1))
            size = np.diff(first)
            digest = [np.append(np.cumsum(ft.mix64(x ^ np.uint64(c))), np.uint64(0)) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            sums = [np.where(first > 0, s[first - 1], np.uint64(0)) for s in digest]
            held = superminhash(doc, x, n)
            s, odd = sketches(held), parities(doc, x, n)
            offs = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                ids[low:high].cast(pa.int64()), pa.array(size.astype(np.int64)),
                *[pa.array(np.diff(v).view(np.int64)) for v in sums],
                pa.ListArray.from_arrays(pa.array(offs), pa.array(band_keys(held)[size > 0].reshape(-1))),
                *[pa.array(np.ascontiguousarray(s[:, k])) for k in range(4)],
                *[pa.array(np.ascontiguousarray(odd[:, k])) for k in range(8)]], names)


def signatures(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").mapInArrow(_signatures, SIGNATURE)


# ---------------------------------------------------------------- verification

_CODEC = "zstd"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, packed): byte length, then the compressed bytes."""
    codec = pa.Codec(_CODEC, compression_level=3)
    for batch in rows_in(batches):
        for low, high, data, offsets in ft.blocks(batch.column(1)):
            packed = [int(e - s).to_bytes(8, "little") + codec.compress(data[s:e].tobytes(), asbytes=True) for s, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0)[low:high].cast(pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "packed"])


def _unpacked(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codec = pa.Codec(_CODEC)
    sizes = [int.from_bytes(v[:8], "little") for v in values]
    raw = b"".join([codec.decompress(v[8:], n, asbytes=True) for v, n in zip(values, sizes)])
    return np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs (u, v, packed text of u, of v) whose sets are similar enough."""
    for batch in rows_in(batches):
        u, v = batch.column(0), batch.column(1)
        a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        low = 0
        while low < len(a):
            high, size = low, 0
            while high < len(a) and (high == low or size < ft.BLOCK_BYTES // 2):
                size += int.from_bytes(a[high][:8], "little")
                high += 1
            n = high - low
            d1, x1 = shingles(*_unpacked(a[low:high]))
            d2, x2 = shingles(*_unpacked(b[low:high]))
            size = np.bincount(d1, minlength=n) + np.bincount(d2, minlength=n)
            d, x = np.concatenate([d1, d2]), np.concatenate([x1, x2])
            order = np.lexsort((x, d))
            d, x = d[order], x[order]
            both = np.bincount(d[1:][(x[1:] == x[:-1]) & (d[1:] == d[:-1])], minlength=n)
            keep = pa.array((both > 0) & (100 * both >= SIMILAR * (size - both)))
            yield pa.RecordBatch.from_arrays([u[low:high].filter(keep), v[low:high].filter(keep)], ["u", "v"])
            low = high


def text_pool(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Packed texts of the documents named in `ids` (id), stored. The texts are
    packed before the shuffle that meets them with their ids, once for all
    verifications."""
    texts = only(docs, "doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(_packed, "doc_id bigint, packed binary")
    return stored(texts.join(ids.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), "pool")


def verified(pairs: DataFrame, pool: DataFrame) -> DataFrame:
    """The pairs (u, v) of doc_ids whose whole texts are linked."""
    a = pool.select(F.col("doc_id").alias("u"), F.col("packed").alias("a"))
    b = pool.select(F.col("doc_id").alias("v"), F.col("packed").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(_verify, "u bigint, v bigint")


def _agree(x: str, y: str) -> Column:
    """Cells of two sketches that agree, of 128."""
    differ = F.lit(0)
    for k in range(4):
        z = F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(z)
    return F.lit(M) - differ


def _plausible(x: str, y: str) -> Column:
    """What two linked sets must satisfy. Exactly: sizes within the similarity,
    and odd sketches no further apart than the sets may be (a link leaves at
    most (100 - SIMILAR) / (100 + SIMILAR) of both sizes outside the
    intersection). And, at five standard deviations, agreeing sketches."""
    a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    apart = F.lit(0)
    for k in range(8):
        apart = apart + F.bit_count(F.col(f"{x}.p{k}").bitwiseXOR(F.col(f"{y}.p{k}")))
    return ((F.least(a, b) * 100 >= F.greatest(a, b) * SIMILAR) & (apart * (100 + SIMILAR) <= (a + b) * (100 - SIMILAR))
            & (_agree(x, y) >= SKETCH_AGREE))


def _mixed(shared: DataFrame, found: DataFrame, of: DataFrame, k: int) -> DataFrame:
    """Members (key, id, c, size, sketch) of the buckets that hold several components."""
    member = (shared.join(found, shared["id"] == found["node"], "left")
              .select("key", "id", F.coalesce("component", "id").alias("c")))
    several = (member.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
               .where("lo < hi").select("key"))
    return stored(member.join(several, "key").join(of, "id"), f"mixed-{k}")


def _remaining(rest: DataFrame) -> tuple[int, int]:
    """Members of the mixed buckets, and pairs of them across components."""
    per = rest.groupBy("key", "c").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
    got = per.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2)).first()
    return int(got[0] or 0), int(got[1] or 0)


def _to_heads(rest: DataFrame, k: int) -> DataFrame:
    """Pairs of every member with its bucket's heads of round k, drawn by hash,
    where they are in different components: HEADS pairs per member and bucket at most."""
    drawn = [F.min_by("id", F.xxhash64("id", "key", F.lit(k * HEADS + n))) for n in range(HEADS)]
    head = rest.groupBy("key").agg(F.array(*drawn).alias("heads")).select("key", F.explode(F.array_distinct("heads")).alias("id"))
    y = rest.join(head, ["key", "id"]).alias("y")
    return (rest.alias("x").join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c")) & _plausible("x", "y"))
            .select(F.greatest("x.id", "y.id").alias("u"), F.least("x.id", "y.id").alias("v")).distinct())


def _across(rest: DataFrame) -> DataFrame:
    """All plausible pairs across components within a bucket."""
    return (rest.alias("x").join(rest.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.c") < F.col("y.c")) & _plausible("x", "y"))
            .select(F.col("x.id").alias("u"), F.col("y.id").alias("v")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest
    doc_id reachable over links) and kept (doc_id = component_id)."""
    sig = stored(signatures(docs), "superminhash")
    sketch = ["n_shingles", *[f"s{k}" for k in range(4)], *[f"p{k}" for k in range(8)]]
    classes = stored(
        sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("d0", "d1", "bands", *sketch).agg(F.min("doc_id").alias("id")), "classes")
    in_bucket = classes.select("id", F.explode("bands").alias("key"))
    heads = in_bucket.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("other")).where("head < other")
    shared = stored(in_bucket.join(heads.select("key", "head"), "key"), "buckets")

    of = classes.select("id", *sketch)
    star = shared.where("id <> head").select("id", "head").distinct().alias("p")
    star = (star.join(of.alias("x"), F.col("p.id") == F.col("x.id"))
            .join(of.alias("y"), F.col("p.head") == F.col("y.id"))
            .where(_plausible("x", "y")).select(F.col("p.id").alias("u"), F.col("p.head").alias("v")))
    pool = text_pool(docs, shared)
    first = stored(verified(star, pool), "links-1")
    found = components(first)

    links, k, before = first, 0, None
    while k >= 0:
        rest = _mixed(shared, found, of, k)
        members, pairs = _remaining(rest)
        if not pairs:
            break
        k += 1
        if pairs > PAIRS_PER_MEMBER * members and (before is None or 4 * pairs < 3 * before):
            new = stored(verified(_to_heads(rest, k), pool), f"links-{k + 1}")
            before = pairs
        else:
            new = stored(verified(_across(rest), pool), "links-last")
            k = -1
        if new.isEmpty():
            continue
        links = links.unionByName(new)
        found = components(links)
    label = (classes.select("d0", "d1", "id").join(found, F.col("id") == F.col("node"), "left")
             .select("d0", "d1", F.coalesce("component", "id").alias("component")))
    return (sig.join(label, ["d0", "d1"], "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i + 1 : i + 5], ' ') END AS k
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_in AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM both_in JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS r FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.r
), comp AS (
  SELECT a, min(r) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id) JOIN comp c ON c.a = d.doc_id
"""


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    return near_duplicates(Tables(spark, sf_dir).documents)
