"""Multi-line CSV read by many tasks a file (S1, S2 at scale).

`multiLine` hands a whole file to one task, because a reader that starts in the
middle cannot tell whether a newline ends a record or stands inside quotes. It
can once the quotes before its block are counted: a newline ends a record if
their number is even (a doubled quote counts two). So

1. the text source reads physical lines, splitting files into blocks as usual;
   each line is stored with its number in the block, whether its own quotes are
   odd, the parity of the quotes before it in its block, and the last line so far
   that would begin a record if the block itself began outside (`open_0`) or
   inside (`open_1`) quotes. The text is read once, whatever the splits were;
2. one row a block is enough for the rest: a prefix sum over the blocks of a file
   says how each block begins, and which record is open there;
3. with that, every line knows its record. Neighbouring lines of a record are put
   together where they are read, so nearly all records are whole there; only those
   cut by the end of a block or batch are grouped, by record.

Quotes must stand in quoted fields only, doubled inside them, as writers that
quote do. A record of more than `most_lines` lines (an unclosed quote swallows
the rest of its file) is not gathered: its lines come back as quarantined.
Lines end with \\n; a \\r before a record's end is dropped, others are text. Empty
records are skipped, as the CSV source does, and with `header` the first record
of each file. Compressed files are one block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from silverline.catalog import stored

MOST_LINES = 100_000
LINES = "file string, block bigint, line bigint, odd int, before int, open_0 bigint, open_1 bigint, value string"
RECORD = "file", "record_block", "record_line"
PIECES = "file string, record_block bigint, record_line bigint, block bigint, line bigint, n_lines bigint, whole boolean, value string"


def _numbered(quote: str) -> Callable:
    """Physical lines with their place in the block and its running parity."""
    names = [c.split()[0] for c in LINES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, line, before, last = None, 0, 0, [-1, -1]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            files, blocks, values = batch.columns
            # a task reads its blocks one after the other
            changes = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
            quotes = pc.count_substring(values, quote).to_numpy(zero_copy_only=False).astype(np.int64)
            for low, high in zip(edges[:-1], edges[1:]):
                if at != (here := (files[low].as_py(), blocks[low].as_py())):
                    at, line, before, last = here, 0, 0, [-1, -1]
                seen = before + np.cumsum(quotes[low:high])
                parity = np.concatenate([[before], seen[:-1]]) & 1
                number = np.arange(line, line + high - low)
                opened = [np.maximum(np.maximum.accumulate(np.where(parity == state, number, -1)), last[state]) for state in (0, 1)]
                yield pa.RecordBatch.from_arrays([
                    files[low:high], blocks[low:high], pa.array(number), pa.array((quotes[low:high] & 1).astype(np.int32)),
                    pa.array(parity.astype(np.int32)), pa.array(opened[0]), pa.array(opened[1]), values[low:high]], names)
                line, before, last = line + high - low, int(seen[-1]) & 1, [int(x[-1]) for x in opened]
    return run


def numbered_lines(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """The stored lines of the files at `path`."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    return stored(lines.mapInArrow(_numbered(quote), LINES), "csv-lines")


def block_starts(lines: DataFrame) -> DataFrame:
    """file, block, inside (1: it begins inside quotes), open (block and line of the record that is open there)."""
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("parity"), F.max("open_0").alias("open_0"), F.max("open_1").alias("open_1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = blocks.withColumn("inside", (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).cast("int"))
    own = F.when(F.col("inside") == 0, F.col("open_0")).otherwise(F.col("open_1"))
    begun = F.when(own >= 0, F.struct(F.col("block").alias("block"), own.alias("line")))
    return known.select("file", "block", "inside", F.last(begun, ignorenulls=True).over(earlier).alias("open"))


def _record(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Lines with the place of their record and whether they begin and end it."""
    found = lines.join(starts, ["file", "block"])
    begun = F.when(F.col("inside") == 0, F.col("open_0")).otherwise(F.col("open_1"))
    here = begun >= 0
    return found.select(
        "file", F.when(here, F.col("block")).otherwise(F.col("open.block")).alias("record_block"),
        F.when(here, begun).otherwise(F.col("open.line")).alias("record_line"), "block", "line", "value",
        ((F.col("before") + F.col("inside")) % 2 == 0).alias("begins"), ((F.col("before") + F.col("inside") + F.col("odd")) % 2 == 0).alias("ends"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a record that follow each other in a batch, put together: whole records, or pieces of one."""
    for batch in batches:
        if not (n := batch.num_rows):
            continue
        file, block, line, begins, ends = (batch.column(x) for x in ("file", "block", "line", "begins", "ends"))
        begins, ends, number = begins.to_numpy(zero_copy_only=False), ends.to_numpy(zero_copy_only=False), line.to_numpy()
        apart = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.concatenate([[True], begins[1:] | apart | (number[1:] != number[:-1] + 1)]))
        edges = np.append(first, n)
        lines = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), batch.column("value"))
        at = pa.array(first)
        yield pa.RecordBatch.from_arrays([
            *[batch.column(x).take(at) for x in (*RECORD, "block", "line")], pa.array(np.diff(edges).astype(np.int64)),
            pa.array(begins[first] & ends[edges[1:] - 1]), pc.binary_join(lines, "\n")], [c.split()[0] for c in PIECES.split(", ")])


def _ended(value: Column) -> Column:
    """The record without the carriage return before its line end."""
    return F.when(value.endswith("\r"), F.substring(value, F.lit(1), F.char_length(value) - 1)).otherwise(value)


def csv_records(spark: SparkSession, path: str, header: bool = True, quote: str = '"', most_lines: int = MOST_LINES) -> tuple[DataFrame, DataFrame]:
    """(records, unassembled): file, record_block, record_line, n_lines, record; and the lines of overlong records."""
    numbered = numbered_lines(spark, path, quote)
    lines = _record(numbered, stored(block_starts(numbered), "csv-blocks"))     # one small row a block
    found = stored(lines.mapInArrow(_pieces, PIECES), "csv-pieces")
    assembled = F.col("whole") & (F.col("n_lines") <= most_lines)
    whole = found.where(assembled).select(*RECORD, "n_lines", "value")
    pieces = found.where(~assembled)
    sizes = pieces.groupBy(*RECORD).agg(F.sum("n_lines").alias("n_lines"))
    long = sizes.where(F.col("n_lines") > most_lines)
    joined = (pieces.join(long.select(*RECORD), list(RECORD), "left_anti").groupBy(*RECORD)
              .agg(F.sum("n_lines").alias("n_lines"), F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
              .select(*RECORD, "n_lines", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")))
    records = whole.unionByName(joined).select(*RECORD, "n_lines", _ended(F.col("value")).alias("record")).where("record <> ''")
    if header:
        records = records.where("NOT (record_block = 0 AND record_line = 0)")
    unassembled = pieces.drop("n_lines").join(long, list(RECORD)).select(
        *RECORD, "n_lines", "block", F.col("line").alias("from"), F.posexplode(F.split("value", "\n")).alias("at", "value"))
    return records, unassembled.select(*RECORD, "n_lines", "block", (F.col("from") + F.col("at")).alias("line"), "value")


def read_csv_split(spark: SparkSession, path: str, schema: StructType, header: bool = True, sep: str = ",", quote: str = '"',
                   mode: str = "FAILFAST", corrupt: str = "_corrupt_record", most_lines: int = MOST_LINES) -> DataFrame:
    """Typed rows of multi-line CSV files, equal to the typed `multiLine` read.

    With mode PERMISSIVE the column `corrupt` holds the text of a record that does not fit the schema, and each line
    of an overlong one; with FAILFAST either fails the read."""
    records, long = csv_records(spark, path, header, quote, most_lines)
    fields = [*schema.fields, StructField(corrupt, StringType())] if mode == "PERMISSIVE" else schema.fields
    options = {"mode": mode, "sep": sep, "quote": quote, "escape": quote, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if mode == "PERMISSIVE":
        options["columnNameOfCorruptRecord"] = corrupt
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rows = records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
    if mode == "PERMISSIVE":
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return rows.unionByName(long.select(*none, F.col("value").alias(corrupt)))
    failed = F.raise_error(F.concat(F.lit("record of too many lines in "), "file"))
    return rows.unionByName(long.select(*[F.when(failed.isNull(), F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]))


def sniff_quoted_dialect(spark: SparkSession, path: str, delimiters: Sequence[str] = (",", ";", "\t", "|"),
                         quotes: Sequence[str] = ('"', "'")) -> DataFrame:
    """Delimiter and quote of the files at `path`: one row with delimiter,
    quote, fields, records, share (of records with that many fields).

    Under each quote, records are put together by its parity and their quoted
    parts taken out; under each delimiter the rest is cut into fields. The pair
    whose records agree best on their number of fields wins (of more than one
    field; then more fields, fewer records, and the order given). A quote that is
    none leaves records unbalanced or split, so they agree less."""
    told = []
    for rank, quote in enumerate(quotes):
        records, _ = csv_records(spark, path, header=False, quote=quote)
        bare = F.regexp_replace("record", f"{quote}[^{quote}]*{quote}", "")
        counts = F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(d).alias("delimiter"), (F.char_length(bare) - F.char_length(F.replace(bare, F.lit(d), F.lit(""))) + 1).alias("fields"))
                           for k, d in enumerate(delimiters)])
        per = records.select(F.explode(counts).alias("c")).groupBy("c.rank", "c.delimiter", "c.fields").agg(F.count("*").alias("n"))
        told.append(per.select(F.lit(rank).alias("quote_rank"), F.lit(quote).alias("quote"), "rank", "delimiter", "fields", "n"))
    shapes = reduce(lambda a, b: a.unionByName(b), told)
    pair = ["quote_rank", "quote", "rank", "delimiter"]
    best = shapes.groupBy(*pair).agg(F.sum("n").alias("records"), F.max(F.struct("n", "fields")).alias("most"))
    scored = best.select(*pair, "records", F.col("most.fields").alias("fields"), (F.col("most.n") / F.col("records")).alias("share"))
    order = F.struct((F.col("fields") > 1).alias("cut"), "share", "fields", -F.col("records"), -F.col("quote_rank"), -F.col("rank"))
    return scored.agg(F.max_by(F.struct("delimiter", "quote", F.col("fields").cast("int").alias("fields"), "records", "share"), order).alias("b")).select("b.*")
