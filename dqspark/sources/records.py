"""Records of CSV files whose quoted fields may hold line breaks, by many tasks.

A task that reads a byte range (a block) of a file cannot tell whether the range
begins inside quotes. But it can tell, for either case, whether it *ends* inside
quotes, and such two-way answers chain: the first scan gives one row per block,
a running composition over the blocks of a file gives the state each begins in,
and in the second scan every task puts the lines of its blocks together to
records. Records that cross the end of a block are pieced together from the
fragments that the first scan has left.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dqspark.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCKS = (
    "file long, start long, out_ends boolean, in_ends boolean, out_tail string, out_only boolean, in_head string, in_tail string"
)


class Quotes:
    """Whether a line ends inside quotes, given that it begins outside or inside.

    A quote opens a field only at its beginning; anywhere else in an unquoted
    field it is a plain character, as are all after the closing one.
    """

    def __init__(self, separator: str = ","):
        s = re.escape(separator)
        field = rf'(?:"(?:[^"]++|"")*+"[^{s}]*+|[^"{s}][^{s}]*+|)'
        self.outside = re.compile(rf"{field}(?:{s}{field})*+", re.S).fullmatch
        self.inside = re.compile(rf'(?:[^"]++|"")*+"[^{s}]*+(?:{s}{field})*+', re.S).fullmatch

    def ends_inside(self, line: str, inside: bool) -> bool:
        return not (self.inside(line) if inside else self.outside(line))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Stretches of lines of one block, in order."""
    files, starts = (batch.column(i).to_numpy() for i in (0, 1))
    edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        if a < b:
            yield (int(files[a]), int(starts[a])), batch.slice(a, b - a)


def _states(lines: pa.Array, inside: bool, quotes: Quotes) -> tuple[np.ndarray, bool]:
    """For each line whether it begins inside quotes, and whether the last one ends so.

    Only lines with a quote are looked at one by one.
    """
    marked = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    begins = np.empty(len(lines), bool)
    at = 0
    for i, line in zip(marked.tolist(), lines.take(pa.array(marked)).to_pylist()):
        begins[at : i + 1] = inside
        inside, at = quotes.ends_inside(line, inside), i + 1
    begins[at:] = inside
    return begins, inside


class _Side:
    """A block read from one of the two states: its first and last fragments."""

    def __init__(self, inside: bool):
        self.inside, self.head, self.tail = inside, [] if inside else None, []
        self.closed = not inside
        self.records = 0

    def take(self, lines: pa.Array, quotes: Quotes) -> None:
        begins, self.inside = _states(lines, self.inside, quotes)
        first = np.flatnonzero(~begins)
        if not len(first):
            (self.tail if self.closed else self.head).extend(lines.to_pylist())
            return
        if not self.closed:
            self.head.extend(lines.slice(0, int(first[0])).to_pylist())
            self.closed = True
        self.records += int(pc.sum(pc.not_equal(pc.utf8_trim_whitespace(lines.take(pa.array(first))), "")).as_py() or 0)
        # What may still be open at the end: the lines since the last record began.
        self.tail = lines.slice(int(first[-1])).to_pylist()


def _scan(separator: str):
    """One row per block: how it ends, and the fragments at its ends, for either beginning."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, key, sides = Quotes(separator), None, None

        def out() -> pa.RecordBatch:
            outside, inside = sides
            row = {
                "file": key[0], "start": key[1], "out_ends": outside.inside, "in_ends": inside.inside,
                "out_tail": "\n".join(outside.tail) if outside.inside else None,
                "out_only": outside.records == 1,
                "in_head": "\n".join(inside.head),
                "in_tail": "\n".join(inside.tail) if inside.inside and inside.closed else None,
            }
            kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
            fields = [f.split() for f in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([row[n]], kinds[k]) for n, k in fields], [n for n, _ in fields])

        for batch in batches:
            for of, lines in _runs(batch):
                if of != key:
                    if key is not None:
                        yield out()
                    key, sides = of, (_Side(False), _Side(True))
                for side in sides:
                    side.take(lines.column(2), quotes)
        if key is not None:
            yield out()

    return work


def _assemble(separator: str):
    """The records that lie within a block, and whether one is the first of its file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, key, inside, open_lines, first = Quotes(separator), None, False, [], False

        def out(values: pa.Array) -> pa.RecordBatch:
            nonlocal first
            # The end of a line may have two characters.
            values = pc.replace_substring_regex(values, r"\r\z", "")
            values = values.filter(pc.not_equal(values, ""))
            heads = np.zeros(len(values), bool)
            if first and len(values):
                heads[0], first = True, False
            return pa.RecordBatch.from_arrays([values, pa.array(heads)], ["value", "first"])

        for batch in batches:
            for of, run in _runs(batch):
                lines = run.column(2)
                if of != key:
                    # A record still open at the end of a block goes on elsewhere.
                    if open_lines and not inside:
                        yield out(pa.array(["\n".join(open_lines)]))
                    key, inside, first = of, run.column(3)[0].as_py(), of[1] == 0
                    open_lines, skipping = [], inside
                begins, inside = _states(lines, inside, quotes)
                starts = np.flatnonzero(~begins)
                if not len(starts):
                    if not skipping:
                        open_lines.extend(lines.to_pylist())
                    continue
                if not skipping and open_lines:
                    open_lines.extend(lines.slice(0, int(starts[0])).to_pylist())
                    yield out(pa.array(["\n".join(open_lines)]))
                skipping = False
                last = int(starts[-1])
                done = starts[:-1]
                if len(done):
                    if len(done) == last - int(starts[0]):
                        yield out(lines.slice(int(starts[0]), len(done)))
                    else:
                        offsets = pa.array((starts - starts[0]).astype(np.int32))
                        whole = lines.slice(int(starts[0]), last - int(starts[0]))
                        yield out(pc.binary_join(pa.ListArray.from_arrays(offsets, whole), "\n"))
                open_lines = lines.slice(last).to_pylist()
        if open_lines and not inside:
            yield out(pa.array(["\n".join(open_lines)]))

    return work


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _begin_states(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the state each begins in: the answers of those before it, chained.

    One row per block: a file of a terabyte has some ten thousand.
    """
    row = F.struct("start", "out_ends", "in_ends")
    chain = F.aggregate(
        F.array_sort("all"),
        F.struct(F.lit(False).alias("inside"), F.array().cast("array<struct<start:bigint,inside:boolean>>").alias("seen")),
        lambda acc, b: F.struct(
            F.when(acc["inside"], b["in_ends"]).otherwise(b["out_ends"]).alias("inside"),
            F.concat(acc["seen"], F.array(F.struct(b["start"].alias("start"), acc["inside"].alias("inside")))).alias("seen"),
        ),
    )
    states = blocks.groupBy("file").agg(F.collect_list(row).alias("all")).select("file", F.inline(chain["seen"]))
    return blocks.join(states, ["file", "start"])


def _crossing(blocks: DataFrame) -> DataFrame:
    """Records that cross the end of a block, from the fragments of the first scan."""
    inside = F.col("inside")

    def part(order: int, opens: bool, text: Column) -> Column:
        heads = (F.col("start") == 0) & F.col("out_only") if opens else F.lit(False)
        return F.struct(F.lit(order).alias("place"), F.lit(opens).alias("opens"), text.alias("text"), heads.alias("heads"))

    head = F.when(inside, part(0, False, F.col("in_head")))
    tail_text = F.when(inside, F.col("in_tail")).otherwise(F.col("out_tail"))
    tail = F.when(tail_text.isNotNull(), part(1, True, tail_text))
    parts = blocks.select("file", "start", F.inline(F.filter(F.array(head, tail), lambda x: x.isNotNull())))
    number = F.count_if("opens").over(W.partitionBy("file").orderBy("start", "place"))
    pieces = parts.withColumn("record", number).groupBy("file", "record")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "place", "text"))), lambda p: p["text"]), "\n")
    return pieces.agg(F.regexp_replace(text, r"\r\z", "").alias("value"), F.bool_or("heads").alias("first")).select("value", "first")


def csv_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """``(value, first)``: every record of the files as text, blank ones left out.

    ``first`` marks the first record of a file, its header. Records within a
    block are put together when the frame is run, in the order of the file;
    those across blocks follow. The first scan runs when the frame is built.
    """
    lines = _lines(spark, path)
    blocks = stage(lines.mapInArrow(_scan(separator), _BLOCKS))
    blocks = stage(_begin_states(blocks))
    # One row of some 20 bytes per block of the files.
    begin = F.broadcast(blocks.select("file", "start", "inside"))
    # Scans of one session cut files alike; were that not so, records would be torn, hence the error.
    known = F.coalesce("inside", F.raise_error(F.lit("the two scans of a CSV file were cut into different blocks")).cast("boolean"))
    marked = lines.join(begin, ["file", "start"], "left").select("file", "start", "value", known.alias("inside"))
    return marked.mapInArrow(_assemble(separator), "value string, first boolean").unionByName(_crossing(blocks))
