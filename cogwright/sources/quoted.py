"""Records of delimited files with quoted fields, split as `csv.reader` splits them, by blocks of a file.

Whether a line break ends a record depends on all quotes before it. A block (what one split of the file holds) is a
function from the state it begins in, inside a quoted field or not, to the state it ends in. There are four such functions:
always inside, always outside, as before, and the opposite. Composing them in the order of blocks gives each block its first
state: what the last constant block said, changed once for each opposite one since. Blocks are then split on their own, and
only records that cross a block's end are put together from pieces.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scratch import written

#: Characters of a record beyond which it is a reject; no more of it is held anywhere.
RECORD_CHARS = 1 << 20
#: Blocks (of some 128 MB each) whose table is sent to all tasks; beyond that, lines are joined to it by a shuffle.
SENT_BLOCKS = 100_000
# What Windows-1252 has for the bytes 0x80 to 0x9f; the five undefined ones stay as they are.
CP1252 = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020, 0x87: 0x2021, 0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152,
    0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022, 0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A, 0x9C: 0x0153,
    0x9E: 0x017E, 0x9F: 0x0178,
}


#: A line and its end: line feeds and carriage returns alone end lines.
_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")


def _physical(value: bytes) -> list[str]:
    """The lines of what stands before one line feed, with their ends: a carriage return ends a line too."""
    text = value.decode("latin-1")
    if not text.isascii():
        text = text.translate(CP1252)
    *first, last = text.split("\r")
    lines = [x + "\r" for x in first]
    if first and not last:
        return [*lines[:-1], lines[-1] + "\n"]
    return [*lines, last + "\n"]


def _blank(fields: list[str]) -> bool:
    return not any(x.strip() for x in fields)


class Splitter:
    """How lines change the state, and the fields of a record's text, as csv.reader has them."""

    def __init__(self, delimiter: str, quote: str) -> None:
        csv.field_size_limit(sys.maxsize)
        self.quote, self.kind = quote, {"delimiter": delimiter, "quotechar": quote}

    def ends_inside(self, line: str, inside: bool) -> bool:
        if self.quote not in line:
            return inside
        reader = csv.reader(iter([(self.quote if inside else "") + line, ""]), **self.kind)
        next(reader)
        return reader.line_num == 2  # it asked for one line more

    def fields(self, text: str) -> list[str]:
        if self.quote not in text:
            return text.rstrip("\r\n").split(self.kind["delimiter"])
        return next(csv.reader(_LINE.findall(text), **self.kind))


def _by_block(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """((file, block, ...), lines) for runs of rows, which are in the order of the file."""
    rows = (r for pdf in batches for r in pdf.itertuples(index=False, name=None))
    row = next(rows, None)
    while row is not None:
        key = row[:-1]

        def lines() -> Iterator[str]:
            nonlocal row
            while row is not None and row[:-1] == key:
                yield from _physical(row[-1])
                row = next(rows, None)

        yield key, lines()


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))


def block_states(spark: SparkSession, path: str, delimiter: str, quote: str) -> DataFrame:
    """(file, block, inside, first_line, bare, head): the state and number of lines that each block begins after.

    bare: the file's last line has no line feed. head: the fields of the file's first record, null where it is too long.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Splitter(delimiter, quote)
        for (file, block, size), lines in _by_block(batches):
            n, n_bytes, out, inside, head, held = 0, 0, False, True, None, ""
            for line in lines:
                n += 1
                n_bytes += len(line)
                open_head = block == 0 and held is not None and head is None
                if quote in line:
                    out, inside = s.ends_inside(line, out), s.ends_inside(line, inside)
                if open_head:
                    held += line
                    if not out:
                        head = s.fields(held)
                    elif len(held) > RECORD_CHARS:
                        held = None
            yield pd.DataFrame({"file": [file], "block": [block], "size": [size], "n": [n], "n_bytes": [n_bytes], "out": [out], "inside": [inside], "head": [head]})

    found = written(_raw_lines(spark, path).mapInPandas(run, "file string, block long, size long, n long, n_bytes long, out boolean, inside boolean, head array<string>"), "blocks")
    order = Window.partitionBy("file").orderBy("block")
    earlier, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    constant = F.col("out") == F.col("inside")
    flips = F.sum((~constant & F.col("out")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = found.withColumn("_flips", flips)
    rows = rows.withColumn("_said", F.when(constant, F.struct(F.col("out").cast("int").alias("v"), F.col("_flips").alias("at"))))
    last = F.last("_said", ignorenulls=True).over(earlier)
    so_far = F.coalesce(F.lag("_flips").over(order), F.lit(0))
    state = (F.coalesce(last["v"], F.lit(0)) + so_far - F.coalesce(last["at"], F.lit(0))) % 2 == 1
    return rows.select(
        "file", "block", state.alias("inside"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_line"), (F.sum("n_bytes").over(whole) > F.col("size")).alias("bare"), F.first("head", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("head"),
    )


_PIECE = "file string, block long, part int, line long, layout int, fields array<string>, text string, n long, bare boolean"


def split_blocks(spark: SparkSession, path: str, states: DataFrame, delimiter: str, quote: str) -> DataFrame:
    """Pieces of (file, block, inside, first_line, bare, layout): part 0 is a whole record, 1 what goes on from an earlier block, 2 what goes on in a later one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Splitter(delimiter, quote)
        columns = ["file", "block", "part", "line", "layout", "fields", "text", "n", "bare"]
        for (file, block, _, inside, line_no, bare, layout), lines in _by_block(batches):
            rows, held, n, state, part = [], [], 0, bool(inside), 1 if inside else 0
            for line in lines:
                line_no += 1
                state = s.ends_inside(line, state)
                n += len(line)
                if n <= RECORD_CHARS:
                    held.append(line)
                else:
                    held = []
                if state:
                    continue
                text = "".join(held) if n <= RECORD_CHARS else None
                fields = s.fields(text) if part == 0 and text is not None else None
                if part or text is None or not _blank(fields):
                    rows.append((file, block, part, line_no, layout, fields, text if part else None, n, bare))
                held, n, part = [], 0, 0
                if len(rows) == 5000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if n:
                # Nothing ended the record here: it began in this block, or all of the block is inside.
                rows.append((file, block, part or 2, line_no, layout, None, "".join(held) if n <= RECORD_CHARS else None, n, bare))
            yield pd.DataFrame(rows, columns=columns)

    lines = _raw_lines(spark, path).withColumn("_row", F.monotonically_increasing_id())
    few = states.count() <= SENT_BLOCKS
    joined = lines.join(F.broadcast(states) if few else states, ["file", "block"])
    joined = joined if few else joined.repartition("file", "block").sortWithinPartitions("file", "block", "_row")
    return joined.select("file", "block", "size", "inside", "first_line", "bare", "layout", "value").mapInPandas(run, _PIECE)


def join_pieces(pieces: DataFrame, delimiter: str, quote: str) -> DataFrame:
    """Whole records (file, line, layout, fields, n) of the pieces of records that cross a block's end."""
    order = Window.partitionBy("file").orderBy("block", "part")
    parts = pieces.filter("part > 0").withColumn("_open", F.last(F.when(F.col("part") == 2, F.col("block")), ignorenulls=True).over(order))
    each = parts.groupBy("file", "_open", "layout", "bare").agg(F.max("line").alias("line"), F.sum("n").alias("n"), F.max(F.struct("block", "part")).alias("_last"), F.sort_array(F.collect_list(F.struct("block", "part", F.when(F.col("n") <= RECORD_CHARS, F.col("text")).alias("text")))).alias("_all"))
    # A last piece of part 2, or one that goes on to the file's end, is a quote that is never closed.
    text = F.when(F.col("n") <= RECORD_CHARS, F.array_join(F.transform("_all", lambda x: x["text"]), ""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Splitter(delimiter, quote)
        for pdf in batches:
            fields = []
            for text, bare in zip(pdf["text"], pdf["bare"], strict=True):
                if text is None:
                    fields.append(None)
                    continue
                inside = False
                for line in _LINE.findall(text):
                    inside = s.ends_inside(line, inside)
                fields.append(s.fields(text[:-1] if inside and bare else text))
            found = pdf.drop(columns=["text", "bare"]).assign(fields=fields)
            yield found[[f is None or not _blank(f) for f in fields]]

    return each.select("file", "line", "layout", "n", text.alias("text"), "bare").mapInPandas(run, "file string, line long, layout int, n long, fields array<string>")


def quoted_records(spark: SparkSession, path: str, states: DataFrame, delimiter: str, quote: str) -> DataFrame:
    """(file, line, layout, fields, n) of all records; line is a record's last line, fields is null where it has over RECORD_CHARS characters.

    Records whose fields are all blank are left out. states: block_states() with a column `layout`, which is handed on.
    """
    pieces = written(split_blocks(spark, path, states, delimiter, quote), "pieces")
    return pieces.filter("part = 0").select("file", "line", "layout", "fields", "n").unionByName(join_pieces(pieces, delimiter, quote))
