"""Quality rules as a bitmask ledger.

`ledger` evaluates every rule once per document and stores the measurements
and one failure bit per rule. A policy is a named, versioned set of rules; it
is applied to the stored bits with one AND, so a new policy version or an
ablation never reads the texts again. `ablation` aggregates the distinct
failure patterns of a policy (2^rules at most) and derives from the counts,
by bit operations, what each rule rejects, rejects alone, and would keep if
dropped.

Defined cases: a null or word-less text has zero measurements and fails the
word count. Lines are split at \\n; a line equals an earlier one byte by byte.
Repeated documents are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.llm import flat_text as ft
from silverline.llm.frames import only, rows_in

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps", "n_letters"
MEASURE_SCHEMA = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)


@dataclass(frozen=True)
class Rule:
    """A document fails where the SQL condition over the measurements holds."""

    bit: int
    name: str
    fails: str


# Bits are never reused: a changed rule takes a new bit.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "capitals", "100 * n_caps > 50 * n_letters"),
    Rule(7, "few_letters", "100 * n_letters < 50 * word_chars"),
)
BASE = ("few_words", "repeated_windows")
# Policies by version: names of the rules that reject.
POLICIES = {
    "base": BASE,
    "v1": BASE + ("symbols", "duplicate_lines", "short_words", "long_words", "capitals", "few_letters"),
}


def policy_mask(version: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[version])


_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[list(SYMBOLS)] = 1
_CAPS = np.zeros(256, np.int32)
_CAPS[0x41:0x5B] = 1
# ASCII letters, and the first byte of every non-ASCII character
_LETTER = _CAPS.copy()
_LETTER[0x61:0x7B] = 1
_LETTER[0xC0:] = 1


def _sums(table: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(table, dtype=np.int64)])[offsets])


def _earlier(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True where the same (doc, hash) stands before, in order of appearance."""
    order = np.lexsort((h, doc))
    again = np.zeros(len(h), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    out = np.empty(len(h), bool)
    out[order] = again
    return out


def _repeat_words(w: ft.Words, n_docs: int) -> np.ndarray:
    h = ft.word_hashes(w)
    at, doc = ft.window_starts(w.first, WINDOW)
    x = ft.window_hash(h, at, WINDOW)
    again = _earlier(doc, x)
    if not again.any():
        return np.zeros(n_docs, np.int64)
    # windows whose hash recurs: those that repeat, and the first of each
    key = np.unique(x[again])
    slot = np.minimum(np.searchsorted(key, x), len(key) - 1)
    maybe = np.flatnonzero(key[slot] == x)
    order = maybe[np.lexsort((x[maybe], doc[maybe]))]
    same = (x[order][1:] == x[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = at[order[twice]]
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return np.bincount(w.doc[np.cumsum(cover[:-1]) > 0], minlength=n_docs)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n_docs = len(offsets) - 1
    w = ft.words_of(data, offsets, ft.NOT_SPACE, lower=False)
    first_byte = (data & 0xC0) != 0x80
    breaks = np.flatnonzero(data == 0x0A)
    start = np.union1d(offsets[:-1], breaks + 1) if n_docs else np.zeros(0, np.int64)
    start = start[start < len(data)]
    doc = np.searchsorted(offsets, start, side="right") - 1
    end = np.minimum(np.append(start[1:], len(data)), offsets[doc + 1]) if len(start) else start
    end = end - ((end > start) & (data[np.maximum(end - 1, 0)] == 0x0A)) if len(start) else end
    word_starts = np.concatenate([[0], np.cumsum(np.bincount(w.start, minlength=len(data)))]) if len(data) else np.zeros(1, np.int64)
    worded = word_starts[end] > word_starts[start]
    start, end, doc = start[worded], end[worded], doc[worded]
    again = _earlier(doc, ft.span_hash(ft.prefix_sums(data), start, end))
    return {
        "n_words": w.per_doc, "word_chars": _sums(ft.NOT_SPACE[data] & first_byte, offsets),
        "n_symbols": _sums(_SYMBOL[data], offsets), "n_dup_lines": np.bincount(doc[again], minlength=n_docs),
        "n_repeat_words": _repeat_words(w, n_docs), "n_lines": np.bincount(doc, minlength=n_docs),
        "n_caps": _sums(_CAPS[data], offsets), "n_letters": _sums(_LETTER[data], offsets),
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in(batches):
        for low, high, data, offsets in ft.blocks(batch.column(1)):
            m = measure(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[low:high].cast(pa.int64()), *[pa.array(m[k].astype(np.int64)) for k in MEASURES]],
                ["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and `failures`: a bit per rule that fails."""
    bits = " | ".join(f"(CASE WHEN {r.fails} THEN {1 << r.bit}L ELSE 0L END)" for r in RULES)
    return only(docs, "doc_id", "text").mapInArrow(_measured, MEASURE_SCHEMA).withColumn("failures", F.expr(bits))


def apply_policy(entries: DataFrame, version: str, name: str = "kept") -> DataFrame:
    """Adds the verdict of a policy version to ledger rows."""
    return entries.withColumn(name, F.col("failures").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablation(entries: DataFrame, version: str) -> DataFrame:
    """Per rule of the policy: documents it rejects, rejects alone, and the
    documents kept by the policy with and without it."""
    mask = policy_mask(version)
    patterns = entries.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("m")).agg(F.count("*").alias("n"))
    rules = [(r.name, 1 << r.bit) for r in RULES if mask >> r.bit & 1]
    per = patterns.select("m", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("bigint").alias("bit")) for name, bit in rules])).alias("r"))
    hit = F.col("m").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("m") == F.col("r.bit")

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return per.groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit).alias("rejected"), total(alone).alias("rejected_alone"),
        total(F.col("m") == 0).alias("kept"), total((F.col("m") == 0) | alone).alias("kept_without"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    rows = ledger(Tables(spark, sf_dir).documents)
    rows = apply_policy(apply_policy(rows, "base", "base_passed"), "v1")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~F.col("base_passed")).alias("base_failed"), "kept", "failures")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), win AS (
  SELECT k, i, array_to_string(w[i + 1 : i + 8], ' ') AS g
  FROM (SELECT k, w, unnest(range(0, len(w) - 7)) AS i FROM w WHERE len(w) >= 8)
), twice AS (
  SELECT k, g FROM win GROUP BY k, g HAVING count(*) > 1
), rep AS (
  SELECT k, count(DISTINCT p) AS n FROM (
    SELECT win.k, unnest(range(i, i + 8)) AS p FROM win JOIN twice ON win.k = twice.k AND win.g = twice.g) GROUP BY k
), line AS (
  SELECT k, l, count(*) AS c FROM (SELECT k, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY k, l
), lines AS (
  SELECT k, sum(c) AS n_lines, sum(c - 1) AS n_dup FROM line GROUP BY k
), m AS (
  SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n_dup, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(lines.n_lines, 0) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_caps,
    length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
  FROM w LEFT JOIN lines USING (k) LEFT JOIN rep USING (k)
), f AS (
  SELECT *, BITS AS failures FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failures & BASE) <> 0 AS base_failed,
  (failures & POLICY) = 0 AS kept, CAST(failures AS BIGINT) AS failures
FROM f
""".replace("BITS", " + ".join(f"(CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END)" for r in RULES)) \
   .replace("BASE", str(policy_mask("base"))).replace("POLICY", str(policy_mask("v1")))
