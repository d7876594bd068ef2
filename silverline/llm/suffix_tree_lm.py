"""Language-model scoring with a probabilistic suffix tree.

Symbols are words (lower-cased A-Z) and one end mark per document; every word
unseen in training is one further symbol, as in the add-one base model. A tree
state is a context of up to DEPTH words. Its next-symbol distribution is the
discounted counts of its followers, the rest of the mass spread by the next
shorter context's distribution, down to the root:

    P(w | s) = max(c(s, w) - DISCOUNT, 0) / c(s) + rest(s) * P(w | suffix(s))

The root is the unigram distribution with absolute discounting, whose discount
(estimated from the counts of counts) is the probability of an unseen word.

Contexts and followers enter with LEAST occurrences at any corpus size, so the
model grows with the corpus; it is a table and never on the driver. A sequence's
id is the hash of the ids of its context (all but its last word) and of its tail
(all but its first). A context is retained when its distribution diverges from
its suffix's by more than chance explains (weighted divergence over its
followers against the chi-square mean plus three deviations); suffixes of
retained contexts are retained too. A word is scored from the state of the
longest retained suffix of the words before it.

Texts become blocks of word numbers, one row a block. Blocks and cells (ranges
of the id space, about CELL_TOKENS tokens each) exchange sorted ids as compressed
arrays: a block asks each cell for its distinct ids, the cell answers in the same
order. Lengths go one after another, and a longer sequence is asked for only
where the answers leave it a chance: in training where its context and its tail
occur LEAST times, in scoring where its context is a state, or its suffix is and
it may be one. Of the blocks that hold a sequence the first one owns it; as a
block holds all parts of its sequences, owners write the model and the
statistics of contexts without a join. Every id is sent once a block, so a
frequent sequence has at most one entry a block and cells are even.

Where the texts to score hold those to learn from, their blocks are made and
answered once: all texts ask, only the learned ones count, so the answers of
training hold every count that scoring needs. Cells also note the ranks of a
block's ids among their own, and answer by them which are states, unasked.

What is stored at once is kept small: word numbers go from frequent to rare
words, counts are written where they stay, apart from the statistics, and a
longest context whose counts alone show that it cannot diverge enough has none.

Defined cases: a null, empty or word-less text is its end mark alone. With no
training row N = V = 0 and every score is 0. A null doc_id is not held out.
Repeated documents are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.llm import flat_text as ft
from silverline.llm.frames import Scratch, bound_batches, held_out, only, packed, rows_in, unpacked
from silverline.session import shuffles_dropped

FOLDS, HELD_OUT = 7, 2
DEPTH = 3
LEAST = 2               # a sequence seen once is no context
DISCOUNT = 0.5
COUNT_BYTES = 6 << 20   # text of a block in training
BLOCK_TEXT = 8 << 20    # and in scoring; a longer text is a block of its own
ROW_BYTES = 64          # what a row adds to its block besides its text
CELL_TOKENS = 4 << 20   # tokens a cell stands for
END = int(ft.hash_words([b"\x00end"])[0])


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and end marks of a block, and n_docs + 1 offsets."""
    w = ft.words_of(data, offsets, ft.NOT_SPACE)
    return np.insert(ft.word_hashes(w), w.first[1:], np.uint64(END)), w.first + np.arange(len(w.first))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def linked_id(context: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Spark's xxhash64(context, tail)."""
    h = np.full(len(context), 42, np.uint64)
    for x in (context, tail):
        h = (h + _P5 + np.uint64(8)) ^ (_turned(x * _P2, 31) * _P1)
        h = _turned(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
    return h


def sequences(t: np.ndarray) -> list[np.ndarray]:
    """Ids of the sequences of 1 to DEPTH + 1 tokens by their first token, across documents too."""
    ids = [t]
    for _ in range(DEPTH):
        ids.append(linked_id(ids[-1][:-1], ids[-1][1:]))
    return ids


# ---------------------------------------------------------------- blocks and cells

BLOCKS = "block bigint, doc_ids array<bigint>, tokens bigint, learned binary, lengths binary, words binary, rarity binary, places binary"
ASKED = "size int, cell bigint, block bigint, keys binary, c binary"
ANSWERS = "size int, cell bigint, block bigint, c binary, mass binary, ranks binary"
WRITTEN = "size int, cell bigint, keys binary, c binary, words bigint, once bigint, twice bigint, suffix binary, total binary, above binary, m binary, kept binary, below binary, gain binary"
STATES = "size int, cell bigint, keys binary, lost binary, m binary"

_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in ddl.split(", ")])


def _batch(ddl: str, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _schema(ddl))


def _sent(keys: np.ndarray) -> bytes:
    """Sorted ids, by their steps."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def _got(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


def _rarity(n: np.ndarray) -> np.ndarray:
    """Of words by their occurrences: one less for twice as many."""
    return (64 - np.frexp(n)[1]).astype(np.uint8)


def _by_rarity(rarity: np.ndarray) -> np.ndarray:
    """Sorted words in the order of their numbers, frequent ones first: small numbers compress best."""
    return np.argsort(rarity, kind="stable").astype(np.uint32)


def _joined(parts: list[np.ndarray], dtype: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _by_cell(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """Cells that have some of the sorted ids, and which."""
    if not len(keys):
        return []
    cell = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edge = np.flatnonzero(np.diff(cell, prepend=-1))
    return [(int(cell[low]), slice(low, high)) for low, high in zip(edge.tolist(), [*edge[1:].tolist(), len(keys)])]


def _cell_bits(tokens: int, cell_tokens: int) -> int:
    """Cells are a power of two, so that they grow with the corpus and are even."""
    return max((max(tokens, 1) - 1) // cell_tokens, 0).bit_length()


def _blocked(limit: int) -> Callable:
    """Texts as blocks: distinct words, the number of each token's word, and which texts are learned (and their tokens)."""
    def block(number: int, held: list) -> pa.Table:
        words, places, n = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True, return_counts=True)
        rarity = _rarity(n)
        number_of = np.empty(len(words), np.uint32)
        number_of[_by_rarity(rarity)] = np.arange(len(words), dtype=np.uint32)
        lengths, learned = np.concatenate([h[1] for h in held]), np.concatenate([h[3] for h in held])
        return _batch(BLOCKS, [{
            "block": number, "doc_ids": [i for h in held for i in h[2]], "tokens": int(lengths[learned].sum()),
            "learned": packed(learned), "lengths": packed(lengths), "words": _sent(words), "rarity": packed(rarity), "places": packed(number_of[places])}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in rows_in(batches):
            for low, high, data, offsets in ft.blocks(batch.column(1), max(limit // 8, 1)):
                t, first = tokens(data, offsets)
                more = len(data) + ROW_BYTES * (high - low)
                if held and size + more > limit:
                    yield from block(number, held).to_batches()
                    number, held, size = number + 1, [], 0
                held.append((t, np.diff(first), batch.column(0).slice(low, high - low).to_pylist(),
                             batch.column(2).slice(low, high - low).to_numpy(zero_copy_only=False)))
                size += more
        if held:
            yield from block(number, held).to_batches()
    return run


class Block:
    """Tokens of a block, and what has been answered about its sequences. Ids, keys
    and answers are kept once a distinct sequence, a token holds their place only."""

    def __init__(self, words: np.ndarray, places: np.ndarray, first: np.ndarray, learned: np.ndarray | None = None):
        self.words, self.places, self.first = words, places.astype(np.int32), first
        self.learned = learned                      # by text
        self.ids = [words[places]]                  # by length, by first token
        self.keys: dict[int, np.ndarray] = {}       # ids of the sequences asked for, sorted, each once
        self.slot: dict[int, np.ndarray] = {}       # their place in `keys` by first token; -1: not asked for
        self.known: dict[int, dict[str, np.ndarray]] = {}   # in the order of `keys`, and 0 for what is not asked for

    @classmethod
    def of(cls, row: pa.Table) -> "Block":
        order = _by_rarity(unpacked(row["rarity"][0].as_py(), np.uint8))
        return cls(_got(row["words"][0].as_py()), order[unpacked(row["places"][0].as_py(), np.uint32)],
                   np.concatenate([[0], np.cumsum(unpacked(row["lengths"][0].as_py(), np.int64))]),
                   unpacked(row["learned"][0].as_py(), np.bool_))

    def ask(self, size: int, chance: Callable) -> None:
        if size == 1:
            self.keys[1], self.slot[1] = self.words, np.append(self.places, np.int32(-1))
            return
        if size > len(self.ids):
            self.ids.append(linked_id(self.ids[-1][:-1], self.ids[-1][1:]))
        at, _ = ft.window_starts(self.first, size)
        if size > 2:
            at = at[chance(self, size, at)]
        self.slot[size] = np.full(len(self.places) + 1, -1, np.int32)
        self.keys[size], self.slot[size][at] = np.unique(self.ids[size - 1][at], return_inverse=True)

    def learn(self, size: int, answer: dict[str, np.ndarray]) -> None:
        """Values in the order of `keys`."""
        self.known[size] = {name: np.append(values, 0) for name, values in answer.items()}

    def told(self, size: int, name: str, at: np.ndarray | slice) -> np.ndarray:
        """Answers about the sequences that begin at some tokens; 0: not asked for."""
        return self.known[size][name][self.slot[size][at]]

    def counts(self, size: int) -> np.ndarray:
        """Occurrences in learned texts of each of `keys`."""
        slot = self.slot[size][:-1][np.repeat(self.learned, np.diff(self.first))]
        return np.bincount(slot + 1, minlength=len(self.keys[size]) + 1)[1:]

    def tokens_of(self, size: int) -> np.ndarray:
        """A first token of each of `keys`."""
        at = np.flatnonzero(self.slot[size] >= 0)
        token = np.zeros(len(self.keys[size]), np.int64)
        token[self.slot[size][at]] = at
        return token

    def hear(self, answers: pa.Table | None, chance: Callable, longest: int = DEPTH + 1) -> None:
        """All lengths answered so far, shortest first."""
        rows = sorted(answers.to_pylist(), key=lambda r: (r["size"], r["cell"])) if answers is not None else []
        for size in range(1, longest + 1):
            self.ask(size, chance)
            mine = [r for r in rows if r["size"] == size]
            self.learn(size, {name: _joined([unpacked(r[name], np.int64) for r in mine], np.int64)
                              for name in ("c", "mass") if not mine or mine[0][name] is not None})

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """(a, b) of every token: its probability is a + b * root."""
        a, b = np.zeros(len(self.places)), np.ones(len(self.places))
        live = np.arange(len(self.places))
        start = np.repeat(self.first[:-1], np.diff(self.first))
        for d in range(1, DEPTH + 1):
            live = live[live - start[live] >= d]
            live = live[self.told(d, "mass", live - d) > 0]
            total = self.told(d, "c", live - d).astype(float)
            rest = DISCOUNT * self.told(d, "mass", live - d) / total
            a[live] = np.maximum(self.told(d + 1, "c", live - d) - DISCOUNT, 0) / total + rest * a[live]
            b[live] *= rest
        return a, b


def _frequent(block: Block, size: int, at: np.ndarray) -> np.ndarray:
    """Training: context and tail occur often enough (the low bit of a count tells the owner)."""
    often = block.known[size - 1]["c"] >> 1 >= LEAST
    slot = block.slot[size - 1]
    return often[slot[at]] & often[slot[at + 1]]


def _reachable(block: Block, size: int, at: np.ndarray) -> np.ndarray:
    """Scoring: the context is a state, or the suffix is one and the sequence may be."""
    state = block.known[size - 1]["mass"] > 0
    slot = block.slot[size - 1]
    return state[slot[at]] | (state[slot[at + 1]] if size <= DEPTH else False)


def _asks(sizes: tuple[int, ...], bits: int, chance: Callable, counted: bool) -> Callable:
    def run(blocks: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        rows = []
        if blocks.num_rows:
            block = Block.of(blocks)
            block.hear(answers, chance, sizes[0] - 1)
            for size in sizes:
                block.ask(size, chance)
                c = block.counts(size) if counted else None
                rows += [{"size": size, "cell": cell, "block": blocks["block"][0].as_py(), "keys": _sent(block.keys[size][of]),
                          "c": packed(c[of]) if counted else None}
                         for cell, of in _by_cell(block.keys[size], bits)]
        return _batch(ASKED, rows)
    return run


def _each(run: Callable) -> Callable:
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(rows):
            for k in range(batch.num_rows):
                yield from run(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()
    return batches


def _answered(blocks: DataFrame, bits: int, chance: Callable, answer: Callable, scratch: Scratch, name: str) -> DataFrame:
    """Answers to all blocks: lengths 1 and 2 together, then one by one."""
    answers = None
    for sizes in [(1, 2), *[(size,) for size in range(3, DEPTH + 2)]]:
        asks = _asks(sizes, bits, chance, chance is _frequent)
        asked = blocks.mapInArrow(_each(asks), ASKED) if answers is None else \
            blocks.groupBy("block").cogroup(answers.drop("ranks").groupBy("block")).applyInArrow(asks, ASKED)
        new = scratch.stored(answer(asked, sizes), f"{name}-{sizes[-1]}")
        answers = new if answers is None else answers.unionByName(new)
    return answers


# ---------------------------------------------------------------- the tree

class Rows:
    """Rows of the model, decoded: counts of sequences; mass of states that goes to the rest,
    lost occurrences and DISCOUNT of each follower, in parts of DISCOUNT."""

    def __init__(self, model: pa.Table):
        rows = model.to_pylist()
        self.groups = []
        for names in (("c",), ("lost", "m")):
            mine = [r for r in rows if r[names[0]] is not None]
            keys = _joined([_got(r["keys"]) for r in mine], np.uint64)
            order = np.argsort(keys)
            got = {x: _joined([unpacked(r[x], np.int64) for r in mine], np.int64)[order] for x in names}
            self.groups.append((keys[order], got if "c" in got else {"mass": (got["lost"] / DISCOUNT).astype(np.int64) + got["m"]}))

    def at(self, ids: np.ndarray) -> dict[str, np.ndarray]:
        """c and mass of some ids; 0: none."""
        out = {}
        for keys, columns in self.groups:
            slot = np.minimum(np.searchsorted(keys, ids), max(len(keys) - 1, 0))
            same = keys[slot] == ids if len(keys) else np.zeros(len(ids), bool)
            for name, values in columns.items():
                out[name] = np.zeros(len(ids), np.int64)
                out[name][same] = values[slot[same]]
        return out


@dataclass
class Tree:
    n: int                                  # training tokens
    v: int                                  # distinct ones
    discount: float                         # of the root
    bits: int                               # of the cells
    model: DataFrame                        # size, cell, keys, c, lost, m

    def root(self, c: np.ndarray) -> np.ndarray:
        """Root probability of words by training count; 0: unseen."""
        return root(self.n, self.v, self.discount, c)

    def weights(self, t: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As `Block.weights`, for a few tokens: reads the cells of their sequences."""
        block = Block(*np.unique(t, return_inverse=True), first)
        cells = {cell for ids in sequences(t) for cell, _ in _by_cell(np.unique(ids), self.bits)}
        rows = self.model.where(F.col("cell").isin(sorted(cells))).toArrow()
        for size in range(1, DEPTH + 2):
            found = Rows(rows.filter(pa.compute.equal(rows["size"], size)))
            block.ask(size, _reachable)
            block.learn(size, found.at(block.keys[size]))
        return block.weights()


def root(n: int, v: int, discount: float, c: np.ndarray) -> np.ndarray:
    unseen = discount * v if n and discount else max(n, 1)
    return np.where(c > 0, np.maximum(c - discount, 0), unseen) / max(n, 1)


def _counts(asked: pa.Table) -> pa.Table:
    """Training: twice the occurrences of each sequence (0: too few), plus one for the first block that has it.
    And the ranks of a block's sequences among those of the cell, of such as may be states."""
    rows = sorted(asked.to_pylist(), key=lambda r: r["block"])
    keys = [_got(r["keys"]) for r in rows]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate([unpacked(r["c"], np.int64) for r in rows])).astype(np.int64)     # exact below 2^53
    one = np.empty(len(total), np.int64)
    one[place[::-1]] = np.arange(len(place))[::-1]      # the last written, so the first block
    if rows[0]["size"] > 1:
        total[total < LEAST] = 0
    c = 2 * total[place]
    c[one] += total > 0
    may, out, low = total >= LEAST, [], 0
    rank = np.cumsum(may) - 1
    for r, k in zip(rows, keys):
        mine = place[low:low + len(k)]
        out.append({"size": r["size"], "cell": r["cell"], "block": r["block"], "c": packed(c[low:low + len(k)]),
                    "ranks": packed(np.diff(rank[mine[may[mine]]], prepend=0).astype(np.uint32)) if r["size"] <= DEPTH else None})
        low += len(k)
    return _batch(ANSWERS, out)


def _chance(m: np.ndarray | int) -> np.ndarray:
    """Divergence that chance explains, over m followers."""
    return m / 2 + 3 * np.sqrt(m / 2) + 3


def _may_diverge(total: np.ndarray, above: np.ndarray) -> np.ndarray:
    """No follower is likelier than always, before or after: a context's divergence is at most total * log(above / total)."""
    return total * np.log(above / total) > _chance(1) * (1 - 1e-6)


def _owned(block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By length: ids of the block's own sequences and a first token of each."""
    for size in range(1, DEPTH + 2):
        mine = block.known[size]["c"][:-1] & 1 > 0
        yield size, block.keys[size][mine], block.tokens_of(size)[mine]


def _written(n: int, bits: int) -> Callable:
    """From the block's own sequences: their counts, as rows of the model, and statistics of their contexts
    (what follows, how often, and how often after the suffix), as rows without `c`. Longest contexts that are
    no states whatever follows are left out; a single follower's gain is told by its counts."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if blocks.num_rows:
            block = Block.of(blocks)
            block.hear(answers, _frequent)

            def count(size: int, at: np.ndarray) -> np.ndarray:
                return block.told(size, "c", at) >> 1

            for size, keys, token in _owned(block):
                c = count(size, token)
                for cell, of in _by_cell(keys, bits):
                    words = {"words": len(c[of]), "once": int((c[of] == 1).sum()), "twice": int((c[of] == 2).sum())} if size == 1 else {}
                    rows.append({"size": size, "cell": cell, "keys": _sent(keys[of]), "c": packed(c[of]), **words})
                if size == 1:
                    continue
                d, tail = size - 1, count(size - 1, token + 1)
                contexts, place = np.unique(block.ids[d - 1][token], return_inverse=True)
                at = np.empty(len(contexts), np.int64)
                at[place] = token
                sums = {"m": np.bincount(place, minlength=len(at)), "kept": np.bincount(place, c, len(at)).astype(np.int64),
                        "below": np.bincount(place, tail, len(at)).astype(np.int64),
                        "total": count(d, at), "above": count(d - 1, at + 1) if d > 1 else np.full(len(at), n),
                        "suffix": block.ids[d - 2][at + 1] if d > 1 else np.zeros(len(at), np.uint64)}
                gain = np.bincount(place, c * np.log(c / tail), len(at))
                if d == DEPTH:
                    may = _may_diverge(sums["total"], sums["above"])
                    contexts, gain, sums = contexts[may], gain[may], {name: x[may] for name, x in sums.items()}
                rows += [{"size": d, "cell": cell, "keys": _sent(contexts[of]), **{name: packed(x[of]) for name, x in sums.items()},
                          "gain": packed(gain[of][sums["m"][of] > 1])}
                         for cell, of in _by_cell(contexts, bits)]
        return _batch(WRITTEN, rows)
    return run


def _retained(d: int, bits: int) -> Callable:
    """States of d words, and, without `m`, the suffixes that they need."""
    def run(contexts: pa.Table, needed: pa.Table | None) -> pa.Table:
        found = contexts.to_pylist()
        if not found:
            return _batch(STATES, [])

        def column(name: str, dtype: type) -> np.ndarray:
            return np.concatenate([unpacked(r[name], dtype) for r in found])

        keys, one, place = np.unique(np.concatenate([_got(r["keys"]) for r in found]), return_index=True, return_inverse=True)
        sums = [column(x, np.int64) for x in ("m", "kept", "below")]
        sums.append(sums[1] * np.log(sums[1] / sums[2]))
        sums[-1][sums[0] > 1] = column("gain", np.float64)
        m, kept, below, gain = (np.bincount(place, x, len(keys)) for x in sums)
        total, above, suffix = column("total", np.int64)[one], column("above", np.int64)[one], column("suffix", np.uint64)[one]
        lost, left = total - kept, above - below
        both = (lost > 0) & (left > 0)
        divergence = gain + kept * np.log(above / total)
        divergence[both] += lost[both] * np.log(lost[both] * above[both] / (left[both] * total[both]))
        state = divergence > _chance(m)
        if needed is not None and needed.num_rows:
            state |= np.isin(keys, np.concatenate([_got(x.as_py()) for x in needed["keys"]]))
        rows = [{"size": d, "cell": found[0]["cell"], "keys": _sent(keys[state]),
                 "lost": packed(lost[state].astype(np.int64)), "m": packed(m[state].astype(np.int64))}]
        if d > 1:
            wanted = np.unique(suffix[state])
            rows += [{"size": d - 1, "cell": cell, "keys": _sent(wanted[of])} for cell, of in _by_cell(wanted, bits)]
        return _batch(STATES, rows)
    return run


def _states(contexts: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """Rows of the model of all states; a state's suffix is one too."""
    states, found = None, None
    for d in range(DEPTH, 0, -1):
        grouped = contexts.where(F.col("size") == d).groupBy("cell")
        retained = _retained(d, bits)
        found = grouped.applyInArrow(lambda rows: retained(rows, None), STATES) if found is None else \
            grouped.cogroup(found.where("m IS NULL").groupBy("cell")).applyInArrow(retained, STATES)
        found = scratch.stored(found, f"states-{d}")
        states = found if states is None else states.unionByName(found)
    return states.where("m IS NOT NULL")


def _texts(docs: DataFrame, learned: Column) -> DataFrame:
    return docs.select("doc_id", "text", F.coalesce(learned, F.lit(False)).alias("learned"))


def _trained(texts: DataFrame, scratch: Scratch) -> tuple[Tree, DataFrame, DataFrame, DataFrame]:
    """The tree, its table, and in `scratch` the blocks of all texts and what they were told about their sequences."""
    lasting = Scratch(texts.sparkSession, "suffix-tree-model")
    blocks = scratch.stored(texts.mapInArrow(_blocked(COUNT_BYTES), BLOCKS), "blocks")
    n = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    bits = _cell_bits(n, CELL_TOKENS)
    answers = _answered(blocks, bits, _frequent, lambda asked, _: asked.groupBy("size", "cell").applyInArrow(_counts, ANSWERS), scratch, "counts")
    written = blocks.groupBy("block").cogroup(answers.drop("ranks").groupBy("block")).applyInArrow(_written(n, bits), WRITTEN)
    written = lasting.stored(written.withColumn("counted", F.col("c").isNotNull()), "written", by="counted")
    counts = written.where("counted").select("size", "cell", "keys", "c", "words", "once", "twice")
    model = counts.unionByName(_states(written.where("NOT counted"), bits, lasting), allowMissingColumns=True)
    lasting.drop("written/counted=false")
    v, once, twice = counts.where("size = 1").agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("words", "once", "twice")]).first()
    discount = once / (once + 2 * max(twice, 1)) if once else 0.0      # below 1: a known word keeps some mass
    return Tree(n, v, discount, bits, model), model, blocks, answers


def train(docs: DataFrame, learn: Column) -> tuple[Tree, DataFrame]:
    """The tree, and its table: per length and cell the ids and counts of sequences, and the ids, lost
    occurrences and followers of states."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "suffix-tree-blocks")
    with shuffles_dropped(spark):
        texts = only(docs, "doc_id", "text").where(learn).withColumn("doc_id", F.lit(None).cast("bigint"))
        tree, model, _, _ = _trained(_texts(texts, F.lit(True)), scratch)
        scratch.drop()
    return tree, model


# ---------------------------------------------------------------- scoring

SCORED = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _found(asked: pa.Table, model: pa.Table) -> pa.Table:
    """Counts, and masses of states, in the order asked."""
    rows = asked.to_pylist()
    found = Rows(model) if rows else None
    out = []
    for r in rows:
        out.append({"size": r["size"], "cell": r["cell"], "block": r["block"],
                    **{name: packed(x) for name, x in found.at(_got(r["keys"])).items()}})
    return _batch(ANSWERS, out)


def _states_of(ranked: pa.Table, model: pa.Table) -> pa.Table:
    """Masses of states, 0 for others, by rank among the cell's frequent sequences."""
    rows = ranked.to_pylist()
    if not rows:
        return _batch(ANSWERS, [])
    found = Rows(model)
    keys, counted = found.groups[0]
    told = found.at(keys[counted["c"] >= LEAST])
    out = []
    for r in rows:
        rank = np.cumsum(unpacked(r["ranks"], np.uint32), dtype=np.int64)
        out.append({"size": r["size"], "cell": r["cell"], "block": r["block"], "mass": packed(told["mass"][rank])})
    return _batch(ANSWERS, out)


def _hear_training(block: Block, answers: pa.Table) -> None:
    """Counts by what training was told, and states by what cells told after it."""
    block.hear(answers.filter(answers["c"].is_valid()), _frequent)
    states = sorted(answers.filter(answers["mass"].is_valid()).to_pylist(), key=lambda r: r["cell"])
    for size in range(1, DEPTH + 2):
        known = block.known[size] = {"c": block.known[size]["c"]}
        if size <= DEPTH:
            may = np.flatnonzero(known["c"][:-1] >> 1 >= LEAST)
            known["mass"] = np.zeros(len(known["c"]), np.int64)
            known["mass"][may] = _joined([unpacked(r["mass"], np.int64) for r in states if r["size"] == size], np.int64)
    for known in block.known.values():
        known["c"] = known["c"] >> 1


def _scored(n: int, v: int, discount: float, hear: Callable) -> Callable:
    floor = np.log10(n + v + 1)

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return _batch(SCORED, [])
        block = Block.of(blocks)
        hear(block, answers)
        docs = len(block.first) - 1
        doc = np.repeat(np.arange(docs), np.diff(block.first))
        a, b = block.weights()
        c = block.told(1, "c", slice(0, -1))
        p = a + b * root(n, v, discount, c)
        known, base, score = (np.bincount(doc, x, docs) for x in (c > 0, np.log10(c + 1.0) - floor, np.log10(np.maximum(p, 1e-300))))
        return pa.Table.from_arrays([
            blocks["doc_ids"].combine_chunks().flatten(), pa.array(np.diff(block.first)), pa.array(known.astype(np.int64)),
            pa.array(np.full(docs, n, np.int64)), pa.array(base), pa.array(score)], schema=_schema(SCORED))
    return run


def score(docs: DataFrame, tree: Tree, model: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document row."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "suffix-tree-scores")

    def answer(asked: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
        rows = model.where(F.col("size").isin(*sizes))
        return asked.groupBy("size", "cell").cogroup(rows.groupBy("size", "cell")).applyInArrow(_found, ANSWERS)

    with shuffles_dropped(spark):
        blocks = scratch.stored(_texts(docs, F.lit(False)).mapInArrow(_blocked(BLOCK_TEXT), BLOCKS), "blocks")
        answers = _answered(blocks, tree.bits, _reachable, answer, scratch, "found")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scored(tree.n, tree.v, tree.discount, lambda block, told: block.hear(told, _reachable)), SCORED)


def train_and_score(docs: DataFrame, learn: Column) -> tuple[Tree, DataFrame, DataFrame]:
    """As `train` and `score` of the same rows, with one set of blocks: the tree, its table and the scores."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "suffix-tree-scores")
    with shuffles_dropped(spark):
        tree, model, blocks, answers = _trained(_texts(docs, learn), scratch)
        ranked = answers.where(F.col("size") <= DEPTH).select("size", "cell", "block", "ranks").groupBy("size", "cell")
        cells = model.where(F.col("size") <= DEPTH).select("size", "cell", "keys", "c", "lost", "m").groupBy("size", "cell")
        found = scratch.stored(ranked.cogroup(cells).applyInArrow(_states_of, ANSWERS), "found")
    told = answers.unionByName(found).drop("ranks")
    return tree, model, blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _scored(tree.n, tree.v, tree.discount, _hear_training), SCORED)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    docs = Tables(spark, sf_dir).documents
    out = held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    _, _, scores = train_and_score(docs, ~out)
    return scores.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
