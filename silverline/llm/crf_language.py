"""Language identification of code-switched text by a linear-chain CRF.

Every letter word of a text is labelled with a language by a conditional random
field: the score of a label sequence is the sum of word scores (affixes of 2-4
bytes, byte 2- and 3-grams, and the word itself as lexicon entry, hashed to one
weight row each) and of learned transition scores. Forward-backward gives the
posterior of every word; a text's language is the one with the largest mean
posterior, and that mean is its score.

Training fits weights and transitions by the exact gradient (expected minus
observed counts, from the same forward-backward) over sequences stitched from
runs of training documents of different languages, so that transitions see
switches. The sample is bounded: PER_LANGUAGE documents of each language, the
smallest by a hash of the id.

Inference is exact on whole texts and vectorised over a block of documents:
texts are cut into segments of SEGMENT words, all segments form their product of
transfer matrices at once, segment ends are chained per document, and all
segments then run forward and backward from their true borders. Word scores are
computed once per distinct word of a block.

Defined cases: null text, or text without any letter (Unicode), is `und` with
score 0. Without a training row everything is `und`. Ties go to the language
first in order. Repeated documents are rows of their own; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from silverline.llm import flat_text as ft
from silverline.llm.frames import held_out, only, rows_in

PER_LANGUAGE = 250
FOLDS, HELD_OUT = 5, 0
BUCKETS = 1 << 16
SEGMENT = 32
SEQUENCES, LENGTH = 1200, 64
RUN = (6, 40)            # words of one document in a stitched sequence
STEPS, RATE, L2 = 60, 0.1, 1e-5
UNDETERMINED = "und"
LABELLED = "doc_id bigint, lang_pred string, score double"


# ---------------------------------------------------------------- features

def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of the given words."""
    sums = ft.prefix_sums(data)
    n = end - start
    word, key = [np.arange(len(start))], [ft.span_hash(sums, start, end)]
    for k in (2, 3, 4):
        at = np.flatnonzero(n >= k)
        for tag, lo in ((1, start[at]), (2, end[at] - k)):
            word.append(at)
            key.append(ft.span_hash(sums, lo, lo + k) + np.uint64(tag))
    for k in (2, 3):
        count = np.maximum(n - k + 1, 0)
        of = np.repeat(np.arange(len(start)), count)
        skip = np.cumsum(count) - count
        lo = np.arange(len(of)) - skip[of] + start[of]
        word.append(of)
        key.append(ft.span_hash(sums, lo, lo + k) + np.uint64(3))
    return np.concatenate(word), (np.concatenate(key) >> np.uint64(20)).astype(np.int64) % BUCKETS


def distinct_words(w: ft.Words) -> tuple[np.ndarray, np.ndarray]:
    """First index of each distinct word, and the distinct number of every word."""
    _, first, number = np.unique(ft.word_hashes(w), return_index=True, return_inverse=True)
    return first, number.reshape(-1)


def summed(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, k], minlength=n) for k in range(values.shape[1])], axis=1)


# ---------------------------------------------------------------- chain

def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows scaled to a largest value of 1 (the scale cancels in posteriors)."""
    return x / np.maximum(x.max(axis=tuple(range(1, x.ndim)), keepdims=True), 1e-300)


def posteriors(scores: np.ndarray, first: np.ndarray, trans: np.ndarray, length: int = SEGMENT) -> np.ndarray:
    """Forward-backward over documents of consecutive words: `scores` words x
    labels, `first` n_docs + 1 word offsets, `trans` log scores."""
    n_words, k = scores.shape
    if not n_words:
        return np.zeros((0, k))
    per = np.diff(first)
    cuts = -(-per // length)
    seg_doc = np.repeat(np.arange(len(per)), cuts)
    rank = np.arange(len(seg_doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    seg_start = first[seg_doc] + rank * length
    seg_len = np.minimum(length, first[seg_doc + 1] - seg_start)
    order = np.argsort(-seg_len, kind="stable")
    back = np.argsort(order)
    live = [int(np.searchsorted(-seg_len[order], -t, side="left")) for t in range(length)]   # segments longer than t
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    start = seg_start[order]
    # product of the transfer matrices (a, then word) of each segment
    prod = np.broadcast_to(np.eye(k), (len(order), k, k)).copy()
    for t in range(length):
        m = live[t]
        if not m:
            break
        prod[:m] = _scaled((prod[:m].reshape(-1, k) @ a).reshape(m, k, k) * e[start[:m] + t][:, None, :])
    prod = prod[back]
    # chained borders: `enter` is the forward vector before a segment's first transition
    enter = np.empty((len(seg_doc), k))
    leave = np.ones((len(seg_doc), k))
    enter[rank == 0] = 1.0      # any label may stand before the first word
    by_rank = np.argsort(rank, kind="stable")
    bounds = np.searchsorted(rank[by_rank], np.arange(rank.max() + 2))
    for r in range(1, rank.max() + 1):
        at = by_rank[bounds[r]:bounds[r + 1]]
        enter[at] = _scaled(np.einsum("si,sij->sj", enter[at - 1], prod[at - 1]))
    for r in range(rank.max() - 1, -1, -1):
        at = by_rank[bounds[r]:bounds[r + 1]]
        at = at[rank[at] + 1 < cuts[seg_doc[at]]]
        leave[at] = _scaled(np.einsum("sij,sj->si", prod[at + 1], leave[at + 1]))
    # inside the segments
    alpha = np.empty((n_words, k))
    v = enter[order]
    for t in range(length):
        m = live[t]
        if not m:
            break
        v[:m] = _scaled((v[:m] @ a) * e[start[:m] + t])
        alpha[start[:m] + t] = v[:m]
    v = leave[order]
    out = alpha
    for t in range(length - 1, -1, -1):
        m = live[t]
        if not m:
            continue
        at = start[:m] + t
        out[at] = alpha[at] * v[:m]
        v[:m] = _scaled((e[at] * v[:m]) @ a.T)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # BUCKETS x languages
    trans: np.ndarray

    def word_scores(self, w: ft.Words) -> np.ndarray:
        first, number = distinct_words(w)
        word, bucket = features(w.data, w.start[first], w.end[first])
        return summed(self.weights[bucket], word, len(first))[number]

    def label(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, end row, language number or -1, score, certainty): the
        score is the language's mean word posterior, the certainty the mean of
        every word's largest one, whatever its language."""
        for low, high, data, offsets in ft.blocks(column):
            n = high - low
            if not self.languages:
                yield low, high, np.full(n, -1), np.zeros(n), np.zeros(n)
                continue
            w = ft.words_of(data, offsets, ft.LETTERS_LOWER)
            p = posteriors(self.word_scores(w), w.first, self.trans)
            mean = summed(p, w.doc, n) / np.maximum(w.per_doc, 1)[:, None]
            best = mean.argmax(axis=1)
            best[~has_letter(w.data, offsets, column, low)] = -1
            sure = np.bincount(w.doc, p.max(axis=1), n) / np.maximum(w.per_doc, 1)
            yield low, high, best, *[np.where(best < 0, 0.0, np.clip(x, 0, 1)) for x in (mean.max(axis=1), sure)]


def has_letter(lowered: np.ndarray, offsets: np.ndarray, column: pa.Array, low: int) -> np.ndarray:
    """True for texts with a letter; the few without an ASCII one are looked at in full."""
    ascii_letter = np.concatenate([[0], np.cumsum((lowered >= 0x61) & (lowered <= 0x7A))])[offsets]
    out = np.diff(ascii_letter) > 0
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in column[low + int(i)].as_py())
    return out


# ---------------------------------------------------------------- training

def fit(texts: list[str], labels: list[int], k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from labelled texts (every word carries its text's label)."""
    rng = np.random.default_rng(seed)
    data, offsets = ft.flatten(pa.array(texts, pa.large_string()))
    w = ft.words_of(data, offsets, ft.LETTERS_LOWER)
    y_doc = np.array(labels)
    usable = [np.flatnonzero((y_doc == c) & (w.per_doc > 0)) for c in range(k)]
    present = [c for c in range(k) if len(usable[c])]
    words, gold = [], []
    for _ in range(SEQUENCES if present else 0):
        seq, lab = [], []
        while len(seq) < LENGTH:
            c = present[rng.integers(len(present))]
            d = usable[c][rng.integers(len(usable[c]))]
            take = int(rng.integers(*RUN))
            at = w.first[d] + rng.integers(max(1, w.per_doc[d] - take + 1))
            run = np.arange(at, min(at + take, w.first[d + 1]))
            seq.extend(run)
            lab.extend([c] * len(run))
        words.append(seq[:LENGTH])
        gold.append(lab[:LENGTH])
    weights, trans = np.zeros((BUCKETS, k)), np.zeros((k, k))
    if not words:
        return weights, trans
    flat, y = np.concatenate(words), np.concatenate(gold)
    sub = ft.Words(w.data, w.start[flat], w.end[flat], np.zeros(len(flat), np.int64), np.array([0, len(flat)]))
    first, number = distinct_words(sub)
    word, bucket = features(w.data, sub.start[first], sub.end[first])
    seen = np.zeros((k, k))
    by_seq = y.reshape(-1, LENGTH)
    np.add.at(seen, (by_seq[:, :-1].ravel(), by_seq[:, 1:].ravel()), 1)
    observed = np.eye(k)[y]
    gw, gt = np.full(weights.shape, 1e-8), np.full(trans.shape, 1e-8)
    for _ in range(STEPS):
        scores = summed(weights[bucket], word, len(first))[number]
        p, expected = expectations(scores, LENGTH, trans)
        d_word = summed(observed - p, number, len(first))
        grad = summed(d_word[word], bucket, BUCKETS) / len(words) - L2 * weights
        grad_t = (seen - expected) / len(words) - L2 * trans
        gw += grad * grad
        gt += grad_t * grad_t
        weights += RATE * grad / np.sqrt(gw)
        trans += RATE * grad_t / np.sqrt(gt)
    return weights, trans


def expectations(scores: np.ndarray, length: int, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word posteriors and expected transition counts of equally long sequences."""
    k = scores.shape[1]
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(-1, length, k)
    a = np.exp(trans - trans.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = _scaled((np.ones((len(e), k)) @ a) * e[:, 0])
    for t in range(1, length):
        alpha[:, t] = _scaled((alpha[:, t - 1] @ a) * e[:, t])
    for t in range(length - 2, -1, -1):
        beta[:, t] = _scaled((e[:, t + 1] * beta[:, t + 1]) @ a.T)
    total = np.zeros((k, k))
    for t in range(1, length):
        x = alpha[:, t - 1][:, :, None] * a * (e[:, t] * beta[:, t])[:, None, :]
        total += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    p = (alpha * beta).reshape(-1, k)
    return p / p.sum(axis=1, keepdims=True), total


def train(docs: DataFrame, learn: Column) -> Model:
    """`learn`: condition over doc_id that a row may be learned from."""
    rows = only(docs, "doc_id", "text", "lang").where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    count = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not count:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    # a hash threshold per language that about 1.3 x PER_LANGUAGE documents pass, repeated rows put together, then the
    # smallest hashes of each language
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    below = F.create_map(*[x for lang, n in count.items() for x in
                           (F.lit(lang), F.lit(1_000_000 if n <= PER_LANGUAGE else int(1_300_000 * PER_LANGUAGE / n) + 1))])
    near = rows.where(h < below[F.col("lang")]).groupBy("lang", h.alias("h"), "doc_id", F.xxhash64("text").alias("digest")).agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "digest")
    picked = (near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= PER_LANGUAGE)
              .orderBy("h", "doc_id", "digest").select("lang", "text").collect())          # at most PER_LANGUAGE texts a language
    languages = sorted(count)
    return Model(languages, *fit([r["text"] for r in picked], [languages.index(r["lang"]) for r in picked], len(languages)))


def label(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document row."""
    names = model.languages + [UNDETERMINED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            for low, high, best, score, _ in model.label(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[low:high].cast(pa.int64()), pa.array([names[b] for b in best], pa.string()),
                    pa.array(score)], ["doc_id", "lang_pred", "score"])
    return only(docs, "doc_id", "text").mapInArrow(run, LABELLED)


def identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of `docs`, all columns, with a determined language and words of at least that mean
    certainty; how many languages share the words does not matter."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            keep = np.concatenate([(b >= 0) & (s >= least) for _, _, b, _, s in model.label(batch.column(at))])
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    docs = Tables(spark, sf_dir).documents
    out = held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    return label(docs, train(docs, ~out)).select("doc_id", out.alias("held_out"), "lang_pred", "score")
