"""Toxicity by non-negative positive-unlabelled learning.

Training sees two sets: documents confirmed toxic (label 1), and unlabelled
text, a random draw from all training documents. A document without a
confirmed label is not taken for clean: with class prior p the risk is

    p * R_pos(+1)  +  max(0, R_unl(-1) - p * R_pos(-1))

where the corrected negative part is kept from going below zero (if it does,
the step goes back along it), which is what stops a flexible model from
explaining the hidden positives away. The prior is the share of label 1 among
the labelled training rows, or a parameter.

Features are word grams: a letter word as a whole and its byte prefixes of 4 to
8. Spark counts, over the training sample, in how many positive and unlabelled
documents each gram stands, and the SELECTED grams that differ most are kept.
Each gives three inputs: presence, repetition, and density (share of the words). The linear
model is trained in numpy on the driver over a bounded sample (POSITIVES +
UNLABELLED documents, the smallest by a hash of the id); scoring reads every
whole text in one pass without a shuffle.

Defined cases: a null or empty text has no grams and scores the model's bias.
Labels without text, null labels and null ids are not learned from; a document
labelled more than once counts as confirmed toxic if any of its rows says so.
Without any confirmed toxic training row every score is 0. A null doc_id is not
held out. Repeated documents are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import stored
from silverline.llm import flat_text as ft
from silverline.llm.frames import held_out, only, rows_in

POSITIVES, UNLABELLED = 3_000, 9_000
SELECTED = 400
SIGNIFICANT = 5.0       # standard deviations between the two sets' shares
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)
TELLING = 20            # grams that the class prior is estimated on
DENSITY = 25.0          # words per hit at which density counts as 1
STEPS, RATE, L2 = 600, 0.05, 5e-5

SCORED = "doc_id bigint, score double"


@dataclass
class Model:
    grams: np.ndarray     # sorted hashes
    weights: np.ndarray   # of presence, repetition and density, grams in order
    bias: float

    def score(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        for low, high, data, offsets in ft.blocks(column):
            doc, slot, n, words = counts(data, offsets, self.grams)
            z = np.full(high - low, self.bias)
            g = len(self.grams)
            z += np.bincount(doc, self.weights[slot] + self.weights[slot + g] * (n > 1)
                             + self.weights[slot + 2 * g] * share(n, words[doc]), minlength=high - low)
            with np.errstate(over="ignore"):      # a bias of minus infinity scores 0
                yield low, high, 1.0 / (1.0 + np.exp(-z))


def share(n: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.minimum(1.0, DENSITY * n / np.maximum(words, 1))


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, gram hash) arrays, one pair per gram kind, and words per document."""
    w = ft.words_of(data, offsets, ft.LETTERS_LOWER)
    sums = ft.prefix_sums(w.data)
    yield w.doc, ft.span_hash(sums, w.start, w.end), w.per_doc
    for k in PREFIXES:
        long = np.flatnonzero(w.end - w.start > k)
        yield w.doc[long], ~ft.span_hash(sums, w.start[long], w.start[long] + k), w.per_doc


def counts(data: np.ndarray, offsets: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, gram number, occurrences) of the held grams, and words per document."""
    docs, slots, words = [], [], np.zeros(len(offsets) - 1, np.int64)
    for doc, h, words in grams(data, offsets):
        slot = np.minimum(np.searchsorted(held, h), max(len(held) - 1, 0))
        hit = held[slot] == h if len(held) else np.zeros(len(h), bool)
        docs.append(doc[hit])
        slots.append(slot[hit])
    key, n = np.unique(np.concatenate(docs) * max(len(held), 1) + np.concatenate(slots), return_counts=True)
    return key // max(len(held), 1), key % max(len(held), 1), n, words


# ---------------------------------------------------------------- training

def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each gram, by class, summed over a block."""
    for batch in rows_in(batches):
        positive = np.asarray(batch.column(1)).astype(np.int64)
        for low, high, data, offsets in ft.blocks(batch.column(0)):
            found = [(d, h) for d, h, _ in grams(data, offsets)]
            doc, h = np.concatenate([d for d, _ in found]), np.concatenate([x for _, x in found])
            order = np.lexsort((doc, h))
            doc, h = doc[order], h[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            doc, h = doc[fresh], h[fresh]
            cut = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            pos = positive[low:high][doc]
            yield pa.RecordBatch.from_arrays([
                pa.array(h[cut].view(np.int64)),
                pa.array(np.add.reduceat(pos, cut) if len(cut) else pos),
                pa.array(np.add.reduceat(1 - pos, cut) if len(cut) else pos)], ["gram", "p", "u"])


def _rows(held: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            for low, high, data, offsets in ft.blocks(batch.column(0)):
                doc, slot, n, words = counts(data, offsets, held)
                at = np.searchsorted(doc, np.arange(high - low + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(1)[low:high], pa.ListArray.from_arrays(pa.array(at), pa.array(slot.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(n > 1)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(share(n, words[doc])))], ["positive", "slot", "twice", "share"])
    return run


def fit_nnpu(x: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE,
             l2: float = L2, beta: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier by the non-negative PU risk
    (logistic loss, Adam). `positive`: confirmed rows; all others are unlabelled."""
    first = int(positive.sum())
    xp, xu = (x[:first], x[first:]) if positive[:first].all() else (x[positive], x[~positive])      # no copy of rows in order
    w, b = np.zeros(x.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        w32 = w.astype(x.dtype)
        gp = 1 / (1 + np.exp(-np.clip(xp @ w32 + b, -60, 60)))
        gu = 1 / (1 + np.exp(-np.clip(xu @ w32 + b, -60, 60)))
        # d/dz of the logistic losses: -(1 - g) for label +1, g for label -1
        pull = -prior * (1 - gp) / len(gp)
        push_p, push_u = -prior * gp / len(gp), gu / len(gu)
        negative = -np.log(np.maximum(1 - gu, 1e-12)).mean() + prior * np.log(np.maximum(1 - gp, 1e-12)).mean()
        if negative < -beta:
            dp, du = -push_p, -push_u
        else:
            dp, du = pull + push_p, push_u
        grad = np.append(dp.astype(x.dtype) @ xp + du.astype(x.dtype) @ xu + l2 * w, dp.sum() + du.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _smallest(ids: DataFrame, n: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def train(docs: DataFrame, labels: DataFrame, learn: Column, prior: float | None = None) -> Model:
    """`learn`: condition over doc_id that a row may be learned from."""
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    told = (only(labels, "doc_id", "toxic").where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, toxic = told.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic:
        return empty
    texts = only(docs, "doc_id", "text")
    confirmed = _smallest(told.where("toxic = 1").select("doc_id"), POSITIVES).withColumn("positive", F.lit(True))
    drawn = _smallest(texts.where(learn & F.col("doc_id").isNotNull()).select("doc_id").distinct(), UNLABELLED) \
        .withColumn("positive", F.lit(False))
    # at most POSITIVES + UNLABELLED ids: a proven bound
    sample = stored(texts.join(F.broadcast(confirmed.unionByName(drawn)), "doc_id").select("text", "positive"), "pu-sample")
    size = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not size.get(True) or not size.get(False):
        return empty
    p, u = F.col("p") / F.lit(size[True]), F.col("u") / F.lit(size[False])
    both = (F.col("p") + F.col("u")) / F.lit(size[True] + size[False])
    deviations = F.abs(p - u) / F.sqrt(both * (1 - both) * F.lit(1 / size[True] + 1 / size[False]) + 1e-12)
    chosen = (sample.mapInArrow(_gram_counts, "gram bigint, p bigint, u bigint")
              .groupBy("gram").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where("p + u >= 5")
              .where(deviations >= SIGNIFICANT).orderBy(deviations.desc(), "gram").limit(SELECTED).collect())
    if prior is None:
        # share of positives in the unlabelled draw: how often the telling grams stand there, against the positives
        top = [r for r in chosen if r["p"] / size[True] > r["u"] / size[False]][:TELLING]
        seen = sum(r["u"] for r in top) / size[False] / max(sum(r["p"] for r in top) / size[True], 1e-9) if top else 1.0
        prior = min(toxic / n, seen)
    prior = float(np.clip(prior, 1e-3, 0.5))
    held = np.sort(np.array([r["gram"] for r in chosen], np.int64).view(np.uint64))
    x, positive = _design(sample.mapInArrow(_rows(held), "positive boolean, slot array<int>, twice array<boolean>, share array<double>").toArrow(), len(held))
    w, b = fit_nnpu(x, positive, prior)
    return Model(held, w, b)


def _design(rows: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sample's dense rows, confirmed ones first, from its columns: no Python object is made per gram."""
    positive = rows["positive"].to_numpy()
    place = np.empty(len(positive), np.int64)
    place[np.argsort(~positive, kind="stable")] = np.arange(len(positive))
    x = np.zeros((len(positive), 3 * n), np.float32)
    flat = [rows[c].combine_chunks() for c in ("slot", "twice", "share")]
    at = np.repeat(place, np.diff(flat[0].offsets.to_numpy()))
    slot, twice, share_ = (c.flatten().to_numpy(zero_copy_only=False) for c in flat)
    x[at, slot] = 1.0
    x[at, slot + n] = twice
    x[at, slot + 2 * n] = share_
    return x, np.sort(positive)[::-1]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            for low, high, s in model.score(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high].cast(pa.int64()), pa.array(s)], ["doc_id", "score"])
    return only(docs, "doc_id", "text").mapInArrow(run, SCORED)


def not_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, that the model does not reject."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches):
            keep = np.concatenate([s for _, _, s in model.score(batch.column(at))]) < THRESHOLD
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    t = Tables(spark, sf_dir)
    out = held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    model = train(t.documents, t.labels, ~out)
    return score(t.documents, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
