"""Spelling variants of a corpus' words by asymmetric q-chunks.

A word of L code points contributes two disjoint chunks, its first L // 2 code
points and the rest. One inserted, deleted or replaced code point lies in one of
them, so the other is found whole in the near word: the first at place 0, the
second moved by the difference in length, at most one place. Inside the struck
chunk one half is whole too, at its place from the same end of the word. It goes
into the key beside the whole chunk, so that a chunk very many words share (a
common beginning) does not bring them all together: a chunk goes out twice, with
either half of the other. The other word of a pair contributes its positional
grams; of these only such can hold what one edit leaves of a word one shorter, as
long or one longer, so only these are sent, four for each of the three lengths.

Chunks and grams are joined on the hash of the key; the banded edit distance of
the whole words is part of the join condition, so only verified pairs leave it,
and each by the first of its common keys, so once. The smaller word of a pair
brings the chunks. Nothing is gathered by chunk or gram. Every join is a sorted
one: words stored in a few MB are some hundred MB as keys, which Spark's estimate
does not see and would have the driver gather for a broadcast.

Words are counted in blocks of text by 64-bit hashes (one hash per block stands
for one word), then by Spark.

A word's form is its most frequent near word, if that is at least FACTOR times
as frequent. Counts rise along forms, so they end; roots are found by pointer
jumping over a stored table, each round doubling the steps.

Defined cases: null and empty texts and texts without letters have no words;
rows that share a doc_id are counted each; a null doc_id reads as empty text in
the id of an altered run; a word may be as long as its text (grams are sent as
hashes). An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import stored
from silverline.llm import flat_text as ft
from silverline.llm.frames import only, rows_in

ALTERED = 97            # of so many runs of a document, one loses a code point
LEAST_CHARS, LEAST_COUNT, FACTOR = 5, 3, 2
COUNT_BYTES = 8 << 20   # text counted at once
LONG_BYTES = 64         # of a longer run the library takes the crc

_ASCII = np.isin(np.arange(256), np.frombuffer(string.ascii_letters.encode(), np.uint8))
_MARKED = np.arange(256) == 1


# ---------------------------------------------------------------- words

def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc32_from(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """zlib.crc32(data[start:end], state) of every span."""
    out = state.astype(np.uint32)
    size = end - start
    for k in np.flatnonzero(size > LONG_BYTES):
        out[k] = zlib.crc32(data[start[k]:end[k]].tobytes(), int(state[k]))
    live = np.flatnonzero(size <= LONG_BYTES)
    inner = ~out[live]
    for at in range(int(size[live].max(initial=0))):
        more = size[live] > at
        live_bytes = data[start[live[more]] + at]
        inner[more] = _CRC[(inner[more] ^ live_bytes) & 255] ^ (inner[more] >> np.uint32(8))
    out[live] = ~inner
    return out


def letters(data: np.ndarray) -> np.ndarray:
    """1 at the bytes of A-Z, a-z and of U+00C0 to U+00FF (the byte C3 and the one after it)."""
    lead = data == 0xC3
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    return inside.view(np.uint8)


def _block_counts(ids: list, data: np.ndarray, offsets: np.ndarray, least_chars: int) -> tuple[list[bytes], list[int]]:
    """Words of a block of texts and how often they occur."""
    w = ft.words_of(letters(data), offsets, _MARKED, lower=False)
    leads = np.concatenate([[0], np.cumsum(data == 0xC3)])
    chars = (w.end - w.start) - (leads[w.end] - leads[w.start])
    long = np.flatnonzero(chars >= least_chars)
    start, end, doc = w.start[long], w.end[long], w.doc[long]
    data = ft.lower(data)
    h = ft.span_hash(ft.prefix_sums(data), start, end)
    # a run of a document is altered alike wherever it stands there
    _, one, n = np.unique(h ^ ft.mix64(doc.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = crc32_from(before[doc[one]], data, start[one], end[one])
    cut = crc % ALTERED == 0
    words, counts = [], []
    for k in np.flatnonzero(cut):
        run = data[start[one[k]]:end[one[k]]].tobytes().decode()
        at = int(crc[k]) % len(run)
        if len(run) > least_chars:
            words.append((run[:at] + run[at + 1:]).encode())
            counts.append(int(n[k]))
    whole, n = one[~cut], n[~cut]
    _, first, which = np.unique(h[whole], return_index=True, return_inverse=True)
    words += [data[start[k]:end[k]].tobytes() for k in whole[first]]
    return words, counts + np.bincount(which, n, len(first)).astype(np.int64).tolist()


def _counted(least_chars: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            ids = batch.column(0).to_pylist()
            for low, high, data, offsets in ft.blocks(batch.column(1), COUNT_BYTES):
                words, counts = _block_counts(ids[low:high], data, offsets, least_chars)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])
    return run


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of the texts that are long and frequent enough."""
    found = only(docs, "doc_id", "text").mapInArrow(_counted(least_chars), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---------------------------------------------------------------- near words

def _keys(word: Column, length: Column) -> list[Column]:
    """Hashes of what one edit of a word of `length` code points can leave of it, as found in `word`.

    The first two hold its first chunk, with either half of the second; the others hold the second, with either half of the first."""
    size = F.char_length(word)
    first = F.floor(length / 2).cast("int")
    second = length - first
    half, other = F.floor(first / 2).cast("int"), F.floor(second / 2).cast("int")

    def held(k: int, front: Column, back: Column) -> Column:
        back_at = F.greatest(size - back, F.lit(0)) + 1
        return F.xxhash64(length, F.lit(k), F.substring(word, F.lit(1), front), F.substring(word, back_at, back))
    none = F.lit(0)
    return [held(0, first + other, none), held(1, first, second - other), held(2, half, second), held(3, none, second + first - half)]


def _sent(words: DataFrame, lengths: list[int], name: str) -> DataFrame:
    """A row for every key of every word, as chunks of its own length (0) or grams of lengths beside it."""
    size = F.char_length("word")
    keys = [F.struct(h.alias("key"), F.lit(k).alias("part")) for d in lengths for k, h in enumerate(_keys(F.col("word"), size + d))]
    return words.select(F.col("word").alias(name), F.col("n").alias(f"{name}_n"), F.explode(F.array(*keys)).alias("k")).select(
        name, f"{name}_n", F.col("k.key").alias(f"{name}_key"), F.col("k.part").alias(f"{name}_part"))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n (a < b) of the words (word, n) that differ by exactly one code point, each pair once."""
    chunks, grams = _sent(words, [0], "a"), _sent(words, [-1, 0, 1], "b")
    length = F.char_length("a")
    both = list(zip(_keys(F.col("a"), length), _keys(F.col("b"), length)))
    first = F.coalesce(*[F.when(x == y, F.lit(k)) for k, (x, y) in enumerate(both)])
    near = (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1) & (F.col("a_part") == first)
    return chunks.join(grams.hint("merge"), (F.col("a_key") == F.col("b_key")) & near).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word reached from each word of (word, form)."""
    chain = stored(forms.select("word", F.col("form").alias("root")), "roots-0")
    k = 0
    while True:
        k += 1
        ahead = chain.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = stored(chain.join(ahead.hint("merge"), F.col("root") == F.col("at"), "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{k}")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        chain = moved.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of words (word, n)."""
    pairs = stored(near_pairs(words), "near-words")
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    per = sides.groupBy("a", "a_n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("b"))).alias("best"))
    likelier = -F.col("best.less") >= factor * F.col("a_n")
    formed = stored(per.select(F.col("a").alias("word"), "n_near", F.when(likelier, F.col("best.b")).alias("form"),
                               F.when(likelier, -F.col("best.less")).alias("form_n")), "forms")
    last = roots(formed.where("form IS NOT NULL"))
    return (words.select("word", "n").join(formed.hint("merge"), "word", "left").join(last.hint("merge"), "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    words = stored(word_counts(Tables(spark, sf_dir).documents), "words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


# crc32 by its bytewise table; near words by what is left when one code point goes.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT doc_id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_CHARS} GROUP BY 1, 2),
coded AS (SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x), 2), lambda i:
           (16 * (instr('0123456789ABCDEF', substring(x, i + 1, 1)) - 1) + instr('0123456789ABCDEF', substring(x, i + 2, 1)) - 1)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM coded, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {ALTERED} = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {LEAST_CHARS} GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
less AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS part FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.part = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.part = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other COLLATE "C") AS k FROM near),
formed AS (SELECT word, n_near, CASE WHEN other_n >= {FACTOR} * n THEN other END AS form, CASE WHEN other_n >= {FACTOR} * n THEN other_n END AS form_n FROM ranked WHERE k = 1),
walk AS (
  SELECT word, form AS root, 1 AS step FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form, w.step + 1 FROM walk w JOIN formed f ON f.word = w.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM walk GROUP BY word)
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN formed f ON f.word = w.word LEFT JOIN ends e ON e.word = w.word
"""
