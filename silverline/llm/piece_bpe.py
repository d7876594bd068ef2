"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The vocabulary (pieces and scores) is read from a model file; encoding and
decoding are done here. A text becomes symbols, one per character, after the
model's normalisation (a leading space, spaces as the space mark). All words of
a batch lie in one flat symbol array. A round looks up the rank of every
adjacent pair, takes the lowest rank per word (segmented minimum), merges that
pair leftmost first, compacts the array, and drops words without a pair.

A round merges all occurrences of its pair in a word at once where that equals
merging them one by one: the merged piece must not start a pair of lower rank
than the one just merged. For the few pieces where it could, only the leftmost
occurrence is merged in that round.

Words: no piece holds a character followed by a space mark, nor a pair of
adjacent characters that no piece holds, so symbols never merge across such
borders and the text may be cut there. Distinct words are encoded once per
batch and kept in a bounded cache.

Symbols that are no piece become byte pieces (byte fallback), or the unknown id
in a model without them. Decoding joins pieces, turns space marks into spaces,
drops the leading space, and reads runs of byte pieces as UTF-8 (each byte that
is not valid becomes U+FFFD).

Supported models: BPE with identity normalisation, a dummy prefix and kept
white space; others are refused. Defined cases: null and empty texts have no
ids and decode to the empty text. Repeated rows are rows of their own; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from silverline.llm.frames import only, rows_in

SPACE = "▁"
CACHE_WORDS = 200_000
CACHE_CHARS = 48            # longer words are encoded per batch, not kept
BATCH_CHARS = 1 << 20
NO_RANK = np.iinfo(np.int32).max
ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as fh:
            proto.ParseFromString(fh.read())
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != trainer.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces \
                or not spec.add_dummy_prefix or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with identity normalisation, a dummy prefix and kept white space are supported")
        kind = pb.ModelProto.SentencePiece
        self.pieces = [p.piece for p in proto.pieces]
        normal = [i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL]
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type == kind.CONTROL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        self.unknown_text = trainer.unk_surface
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.id_of = {self.pieces[i]: i for i in normal}
        # symbols: pieces by id, then characters that stand in pieces without being one, then any other character
        self.n = len(self.pieces)
        extra = sorted({c for i in normal for c in self.pieces[i]} - set(self.id_of))
        self.char_id = {c: self.n + k for k, c in enumerate(extra)} | {p: i for p, i in self.id_of.items() if len(p) == 1}
        self.base = self.n + len(extra) + 1
        self.foreign = self.base - 1
        symbol = {c: s for c, s in self.char_id.items()} | self.id_of
        order = sorted(normal, key=lambda i: (-proto.pieces[i].score, i))
        rank_of = {i: r for r, i in enumerate(order)}
        keys, ranks, made, grams = [], [], [], set()
        lowest_after: dict[int, int] = {}
        for i in normal:
            p = self.pieces[i]
            grams.update(p[k:k + 2] for k in range(len(p) - 1))
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    ranks.append(rank_of[i])
                    made.append(i)
                    for part in (a, b):
                        lowest_after[part] = min(lowest_after.get(part, NO_RANK), rank_of[i])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.made = np.array(made, np.int64)[order]
        # merging into piece i may open a pair of lower rank than its own
        self.jumps = np.zeros(self.base, bool)
        for i in normal:
            self.jumps[i] = lowest_after.get(i, NO_RANK) < rank_of[i]
        self.grams = np.array(sorted(ord(g[0]) << 21 | ord(g[1]) for g in grams), np.int64)
        codes = sorted(ord(c) for c in self.char_id)
        self.codes = np.array(codes, np.int64)
        self.code_symbol = np.array([self.char_id[chr(c)] for c in codes], np.int64)
        self.width = np.array([len(p) for p in self.pieces], np.int64)
        self.raw = [b"" if i in self.silent else bytes([self.byte_of[i]]) if i in self.byte_of else
                    self.unknown_text.encode() if i == self.unknown else p.replace(SPACE, " ").encode()
                    for i, p in enumerate(self.pieces)]
        self.digits = [str(i) for i in range(self.n)]
        self.cache: dict[str, tuple[int, str, bytes]] = {}

    # ------------------------------------------------------------ encoding

    def _pairs(self, sym: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol with the next one of its word."""
        rank = np.full(len(sym), NO_RANK, np.int32)
        made = np.zeros(len(sym), np.int64)
        key = sym[:-1] * self.base + sym[1:]
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = np.flatnonzero((self.keys[slot] == key) & same)
        rank[hit] = self.ranks[slot[hit]]
        made[hit] = self.made[slot[hit]]
        return rank, made

    def merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their word numbers (ascending) after all merges."""
        done_sym, done_word = [], []
        while len(sym):
            rank, made = self._pairs(sym, word[1:] == word[:-1])
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(first, len(sym)))
            low = np.minimum.reduceat(rank, first)
            low_here = np.repeat(low, sizes)
            live = low_here < NO_RANK
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            take = live & (rank == low_here)
            sym, word, made, take = sym[live], word[live], made[live], take[live]
            at = np.flatnonzero(take)
            if not len(at):
                break
            # pairs that share a symbol (a run of equal ones): every second, from the left
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])
            offset = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            keep = offset % 2 == 0
            # pieces that may open a lower pair: the leftmost of the word only
            leftmost = np.concatenate([[True], word[at][1:] != word[at][:-1]])
            at = at[keep & (leftmost | ~self.jumps[made[at]])]
            sym = sym.copy()
            sym[at] = made[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, word = sym[stay], word[stay]
        out, number = np.concatenate(done_sym or [sym]), np.concatenate(done_word or [word])
        order = np.argsort(number, kind="stable")
        return out[order], number[order]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (space marks as spaces), without a dummy prefix."""
        codes = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(x) for x in words], np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        slot = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        sym = np.where(self.codes[slot] == codes, self.code_symbol[slot], self.foreign)
        # cut where no piece holds the two adjacent characters
        cut = np.ones(len(codes), bool)
        if len(codes):
            gram = codes[:-1] << 21 | codes[1:]
            g = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
            cut[1:] = (self.grams[g] != gram) | (owner[1:] != owner[:-1])
        start = np.flatnonzero(cut)
        merged, number = self.merge(sym, np.cumsum(cut) - 1)
        count = np.ones(len(merged), np.int64)
        strange = np.flatnonzero(merged >= self.n)
        if len(strange):
            # symbols cover the characters in order, so widths give each symbol's place
            width = np.where(merged < self.n, self.width[np.minimum(merged, self.n - 1)], 1)
            place = (np.cumsum(width) - width)[strange]
            fallen = [self._fallback(chr(c)) for c in codes[place].tolist()]
            count[strange] = [len(f) for f in fallen]
            spread = np.repeat(merged, count)
            spread[spread >= self.n] = [i for f in fallen for i in f]
        else:
            spread = merged
        per_word = np.bincount(owner[start[number]], count, len(words)).astype(np.int64)
        ids, ends = spread.tolist(), np.cumsum(per_word).tolist()
        return [ids[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends)]

    def _fallback(self, char: str) -> list[int]:
        if not self.byte_id:
            return [self.unknown]
        return [self.byte_id[b] for b in char.encode("utf-8")]

    def encode(self, text: str | None) -> list[int]:
        return [i for w in self.encode_words(cut_words(text)) for i in w] if text else []

    # ------------------------------------------------------------ decoding

    def surface(self, ids: list[int]) -> bytes:
        """Bytes of ids with space marks as spaces and every leading space kept."""
        joined = b"".join([self.raw[i] for i in ids])
        try:
            joined.decode()      # pieces are whole characters, so the byte runs between them are valid too
            return joined
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run += self.raw[i]
            else:
                out += [valid_utf8(bytes(run)), self.raw[i]]
                run.clear()
        return b"".join([*out, valid_utf8(bytes(run))])

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that the dummy prefix adds is dropped."""
        first = next((i for i in ids if i not in self.silent), None)
        s = self.surface(ids)
        return (s[1:] if first is not None and self.pieces[first].startswith(SPACE) else s).decode()

    # ------------------------------------------------------------ documents

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, digest of the ids, digest of the decoded text) of each text."""
        split = [cut_words(t) if t else [] for t in texts]
        known = self.cache
        if len(known) > CACHE_WORDS:
            known.clear()
        new = list(set().union(*split).difference(known))
        digits = self.digits
        for w, ids in zip(new, self.encode_words(new)):
            known[w] = len(ids), ",".join([digits[i] for i in ids]), self.surface(ids)
        for ws in split:
            if not ws:
                yield 0, EMPTY, EMPTY
                continue
            n, ids, raw = zip(*map(known.__getitem__, ws))
            # the first id is a piece that starts with the prefix space
            yield sum(n), hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(b"".join(raw)[1:]).hexdigest()
        for w in new:
            if len(w) > CACHE_CHARS:
                del known[w]


EMPTY = hashlib.sha256(b"").hexdigest()


def valid_utf8(raw: bytes) -> bytes:
    """UTF-8 with every byte outside a valid character replaced by U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for size in (1, 2, 3, 4):
            try:
                raw[i:i + size].decode()
                out.append(raw[i:i + size])
                i += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            i += 1
    return b"".join(out)


_CUT = re.compile(r"\n| *[^ \n]+| +")


def cut_words(text: str) -> list[str]:
    """Pieces of the prefixed text that never merge with each other."""
    return _CUT.findall(" " + text.replace(SPACE, " "))


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    """The model, opened once per Python worker."""
    return PieceModel(path)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in rows_in(batches):
            texts = batch.column(1).to_pylist()
            for low, high in _slices(texts):
                n, ids, text = zip(*model.digests(texts[low:high]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high].cast(pa.int64()), pa.array(n, pa.int64()),
                                                  pa.array(ids), pa.array(text)], ENCODED_NAMES)
    return only(docs, "doc_id", "text").mapInArrow(run, ENCODED)


ENCODED_NAMES = [c.split()[0] for c in ENCODED.split(", ")]


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in rows_in(batches):
            texts = batch.column(1).to_pylist()
            for low, high in _slices(texts):
                ids = [model.encode(t) for t in texts[low:high]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high].cast(pa.int64()),
                                                  pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of (doc_id, ids) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        for batch in rows_in(batches):
            texts = [model.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return only(rows, "doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def model_path() -> str:
    """Where the environment keeps its 32k BPE model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    return encode_digests(Tables(spark, sf_dir).documents, model_path())
