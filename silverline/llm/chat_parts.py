"""Chat formatting of turns with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor
flattens them in order: text is kept, any other part becomes a placeholder, and
its reference and the number of tokens it expands to are recorded. The template
marks turns with control strings,

    <|im_start|>role NEWLINE content <|im_end|> NEWLINE

and texts are escaped reversibly, so they never hold a control string: `<|`
(with any number of backslashes between) gets one more backslash. Formatting
maps turns one by one, without a shuffle; the loss mask is a list of code point
ranges, the assistant's texts without markers and placeholders.

`read_back` parses the formatted output, turn by turn, and `conversations`
folds it per conversation in turn order. The rows of a conversation stream
through one sorted partition with a running digest, so a very long
conversation costs time but no memory.

Defined cases: null text and role are empty; a null part list is an empty
content; a part of unknown kind is a placeholder of no tokens. Turns with equal
numbers are ordered by role, then content. Repeated turns are turns of their
own. Rows without conv_id form one conversation. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.catalog import stored
from silverline.llm.frames import only, rows_in

START, STOP = "<|im_start|>", "<|im_end|>"
# Tokens that a part expands to: per image tile, second of audio, page of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
LOSS_ROLE = "assistant"

PART = "struct<kind:string,text:string,ref:string,units:int>"
FORMATTED = ("conv_id bigint, turn bigint, formatted string, loss array<struct<lo:int,hi:int>>, "
             "attachments array<struct<ord:int,kind:string,ref:string,tokens:bigint>>, expanded_tokens bigint")
READ = "conv_id bigint, turn bigint, role string, text string, loss_text string, formatted_chars bigint, is_loss boolean"
FOLDED = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(STOP) + "\n", re.S)
_PLACEHOLDER = re.compile(r"<\|(\w+):(\d+)\|>")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: f"<{m[1]}\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: f"<{m[1]}|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Flattener:
    """Visits the parts of one turn; holds the content, its text ranges and attachments."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.texts: list[tuple[int, int]] = []
        self.attachments: list[dict] = []
        self.pending: list[str] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        # neighbouring texts are one text, so that escaping sees their border
        self.pending.append(part["text"] or "")

    def visit_other(self, part: dict) -> None:
        self.flush()
        kind, n = part["kind"] or "unknown", len(self.attachments)
        self._put(f"<|{re.sub(r'\W', '_', kind)}:{n}|>")
        self.attachments.append({"ord": n, "kind": kind, "ref": part["ref"],
                                 "tokens": TOKENS_PER_UNIT.get(kind, 0) * (1 if part["units"] is None else part["units"])})

    visit_image = visit_audio = visit_document = visit_other

    def flush(self) -> None:
        if self.pending:
            low = self.length
            self._put(escape("".join(self.pending)))
            self.texts.append((low, self.length))
            self.pending.clear()

    def _put(self, s: str) -> None:
        self.pieces.append(s)
        self.length += len(s)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, list[dict], list[dict]]:
    """Formatted turn, loss ranges in it, attachments."""
    v = Flattener()
    for part in parts or []:
        if part is not None:
            v.visit(part)
    v.flush()
    head = f"{START}{escape_role(role or '')}\n"
    loss = [{"lo": len(head) + lo, "hi": len(head) + hi} for lo, hi in v.texts] if role == LOSS_ROLE else []
    return f"{head}{''.join(v.pieces)}{STOP}\n", loss, v.attachments


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, content with placeholders, unescaped) of formatted turns."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {formatted[at:at + 40]!r}")
        yield unescape_role(m[1]), unescape(m[2])
        at = m.end()


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])
    attachment = pa.struct([("ord", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
    for batch in rows_in(batches):
        rows = [format_turn(r, p) for r, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int64()), pa.array([r[0] for r in rows], pa.string()),
            pa.array([r[1] for r in rows], pa.list_(span)), pa.array([r[2] for r in rows], pa.list_(attachment)),
            pa.array([sum(a["tokens"] for a in r[2]) for r in rows], pa.int64())],
            ["conv_id", "turn", "formatted", "loss", "attachments", "expanded_tokens"])


def format_turns(turns: DataFrame) -> DataFrame:
    """Formats (conv_id, turn, role, parts) rows; parts: array<PART>."""
    return only(turns, "conv_id", "turn", "role", "parts").mapInArrow(_format, FORMATTED)


def text_parts(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of turns whose content is one text."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in(batches):
        out = []
        for conv, turn, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
            for role, text in parse_turns(formatted):
                out.append((conv, turn, role, text, "".join(unescape(formatted[s["lo"]:s["hi"]]) for s in loss), len(formatted), bool(loss)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                                         [c.split()[0] for c in READ.split(", ")])


def read_back(formatted: DataFrame) -> DataFrame:
    """Role, text, text under the loss mask and length of every formatted turn."""
    return only(formatted, "conv_id", "turn", "formatted", "loss").mapInArrow(_read, READ)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FOLDED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state, done = None, []

    def result() -> tuple:
        conv, n, turns, chars, loss, length = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in rows_in(batches):
        for conv, role, text, loss_text, length in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(result())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(loss_text)
            state[4].update(loss_text.encode())
            state[5] += length
        if done:
            yield batch_of(done)
            done = []
    if state is not None:
        yield batch_of([result()])


def conversations(read: DataFrame) -> DataFrame:
    """One row per conversation: turns and loss text digests, lengths."""
    return (read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text", "loss_text", "formatted_chars").mapInArrow(_fold, FOLDED))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    given = only(Tables(spark, sf_dir).conversations, "conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"))
    formatted = stored(format_turns(text_parts(given.unionByName(own))), "chat")
    return conversations(read_back(formatted))
