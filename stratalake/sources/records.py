"""Records of JSON arrays and of CSV files with quoted line breaks, found in byte ranges.

Spark splits text at a separator, so a single large file is read by as many tasks as it has ranges.
Whether a separator ends a record depends on all text before it: an odd number of quotes puts it
inside a string, and brackets nest. Each range is therefore summed up first, as the parity of its
quotes and the change of depth for either parity at its begin. These sums are composed in file order
to the state every range begins in, and a second pass over the ranges cuts the records. What begins
or ends outside a range is sent on as a fragment, at most two for each range, and put together with
those of its neighbours. No other text is moved.

The ranges are those of Spark's scan, so one of them begins at most every
``spark.sql.files.maxPartitionBytes``; their states are broadcast once their size is checked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.operators.sizes import BROADCAST_LIMIT, measured_bytes
from stratalake.session import scratch_folder, settings

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1


@dataclass(frozen=True)
class Format:
    """How records are told apart: by a separator outside quotes, and for ``nested`` text by depth.

    ``escapes`` says that a backslash takes the meaning from the quote after it.
    """

    separator: bytes
    nested: bool
    escapes: bool

    def marks(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes, which of them lie after an odd number of quotes, and their change of depth."""
        if self.escapes and b"\\" in data:
            data = _ESCAPED.sub(b"  ", data)
        raw = np.frombuffer(data, np.uint8)
        odd = np.bitwise_xor.accumulate(raw == ord('"')) if len(raw) else np.zeros(0, bool)
        return raw, odd, _STEP[raw] if self.nested else np.zeros(len(raw), np.int8)


ARRAY = Format(b"}", nested=True, escapes=True)
LINES = Format(b"\n", nested=False, escapes=False)
ESCAPED_LINES = Format(b"\n", nested=False, escapes=True)


def _ranges(batches: Iterator[pa.RecordBatch], separator: bytes) -> Iterator[tuple]:
    """(range, data, state) of runs of rows of one range; ``state`` is its row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(name).to_numpy() for name in ("file", "block"))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            part = batch.slice(begin, end - begin)
            data = separator.join([*part.column("value").to_pylist(), b""])
            yield (int(file[begin]), int(block[begin])), data, part


def _summed(batches: Iterator[pa.RecordBatch], kind: Format) -> Iterator[pa.RecordBatch]:
    """Per range: parity of quotes, change of depth from outside and from inside a string."""
    now, odd, steps = None, False, [0, 0]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([odd]),
             pa.array(steps[:1], pa.int64()), pa.array(steps[1:], pa.int64())],
            names=["file", "block", "odd", "from_outside", "from_inside"])

    for where, data, _ in _ranges(batches, kind.separator):
        if where != now:
            if now is not None:
                yield row()
            now, odd, steps = where, False, [0, 0]
        raw, after, step = kind.marks(data)
        inside = after ^ odd
        steps = [steps[0] + int(step[~inside].sum()), steps[1] + int(step[inside].sum())]
        odd = bool(inside[-1]) if len(raw) else odd
    if now is not None:
        yield row()


_OUT = "file long, block long, part int, first boolean, text binary"
#: What a row of text is: a whole record, the rest of one that began before, or the begin of one.
_WHOLE, _REST, _MORE, _BEGIN = 0, 1, 2, 3


class _Cutter:
    """Cuts one range into records; ``rest`` is on while a record from before is not over."""

    def __init__(self, where: tuple[int, int], inside: bool, depth: int, kind: Format):
        self.where, self.kind, self.inside, self.depth = where, kind, inside, depth
        self.open = depth >= 2 if kind.nested else inside
        self.rest, self.kept, self.fresh = self.open, [], True

    def borders(self, data: bytes) -> tuple[list[int], list[int]]:
        """Where records begin, and where they end (the place after)."""
        raw, odd, step = self.kind.marks(data)
        inside = odd ^ self.inside
        if not self.kind.nested:
            ends = (np.flatnonzero((raw == self.kind.separator[0]) & ~inside) + 1).tolist()
            self.inside = bool(inside[-1])
            return ([] if self.open else [0]) + ends, ends
        step = np.where(inside, 0, step)
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        begins = np.flatnonzero((step > 0) & (depth == 2) & (raw == ord("{")))
        ends = np.flatnonzero((step < 0) & (depth == 1) & (raw == ord("}"))) + 1
        self.inside, self.depth = bool(inside[-1]), int(depth[-1])
        return begins.tolist(), ends.tolist()

    def cut(self, data: bytes) -> list[tuple[int, bool, bytes]]:
        if not data:
            return []
        begins, ends = self.borders(data)
        found, at = [], 0
        if self.open:
            if not ends:
                self.kept.append(data)
                return []
            found.append(self._row(_REST if self.rest else _WHOLE, b"".join(
                [*self.kept, data[:ends[0]]])))
            self.kept, self.open, self.rest, at = [], False, False, 1
        for begin, end in zip(begins, ends[at:]):
            found.append(self._row(_WHOLE, data[begin:end]))
        if len(begins) > len(ends) - at:
            last = data[begins[-1]:]
            if last or self.kind.nested:
                self.open, self.kept = True, [last]
        return found

    def closed(self) -> list[tuple[int, bool, bytes]]:
        if not self.open:
            return []
        return [self._row(_MORE if self.rest else _BEGIN, b"".join(self.kept))]

    def _row(self, part: int, text: bytes) -> tuple[int, bool, bytes]:
        first = self.fresh and self.where[1] == 0 and part != _REST
        self.fresh = False
        return part, first, text


def _cut(batches: Iterator[pa.RecordBatch], kind: Format) -> Iterator[pa.RecordBatch]:
    cutter = None

    def rows(found: list[tuple[int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
        if found:
            part, first, text = zip(*found)
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([cutter.where[0]] * n, pa.int64()), pa.array([cutter.where[1]] * n,
                 pa.int64()), pa.array(part, pa.int32()), pa.array(first, pa.bool_()),
                 pa.array(text, pa.binary())], names=["file", "block", "part", "first", "text"])

    for where, data, part in _ranges(batches, kind.separator):
        if cutter is None or cutter.where != where:
            if cutter is not None:
                yield from rows(cutter.closed())
            if kind.nested and not where[1] and data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1] != b"[":
                raise ValueError("a JSON array is expected: the file does not begin with [")
            cutter = _Cutter(where, part.column("inside")[0].as_py(),
                             part.column("depth")[0].as_py(), kind)
        yield from rows(cutter.cut(data))
    if cutter is not None:
        yield from rows(cutter.closed())


def _pieces(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    source = spark.read.option("lineSep", kind.separator.decode()).text(path)
    return source.select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def _states(pieces: DataFrame, kind: Format) -> DataFrame:
    """(file, block, inside, depth) that each range begins in."""
    sums = pieces.mapInArrow(
        lambda batches: _summed(batches, kind),
        "file long, block long, odd boolean, from_outside long, from_inside long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum(F.col("odd").cast("long")).over(before), F.lit(0))
    step = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    known = sums.withColumn("inside", F.pmod(quotes, F.lit(2)) == 1).withColumn("step", step)
    depth = F.coalesce(F.sum("step").over(before), F.lit(0))
    return known.select("file", "block", "inside", depth.cast("int").alias("depth"))


def split_records(spark: SparkSession, path: str, kind: Format) -> DataFrame:
    """(file, first, text) of the records below ``path``; ``first`` marks the first of a file.

    ``file`` is a hash of its path. A stored result, read from the shared folder.
    """
    pieces = _pieces(spark, path, kind)
    kept = scratch_folder(spark)
    _states(pieces, kind).write.parquet(kept)
    states = spark.read.parquet(kept)
    size = measured_bytes(states)
    if size > BROADCAST_LIMIT:
        raise ValueError("too many ranges: raise spark.sql.files.maxPartitionBytes")
    # Both passes have to see the same ranges; a range without a state fails the job.
    met = pieces.join(F.broadcast(states), ["file", "block"], "left").withColumn(
        "depth", F.coalesce("depth", F.raise_error(F.lit("the ranges of the input changed"))))
    folder = scratch_folder(spark)
    met.select("value", "file", "block", "inside", "depth").mapInArrow(
        lambda batches: _cut(batches, kind), _OUT).write.parquet(folder)
    found = spark.read.parquet(folder)
    # The rest of a record comes before the next one's begin in a range.
    order = Window.partitionBy("file").orderBy("block", "part")
    fragments = found.where(F.col("part") != _WHOLE).withColumn(
        "chain", F.sum((F.col("part") == _BEGIN).cast("int")).over(order))
    joined = fragments.groupBy("file", "chain").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("parts")).select(
            "file", "first", F.aggregate(
                "parts.text", F.lit(b""), lambda text, more: F.concat(text, more)).alias("text"))
    whole = found.where(F.col("part") == _WHOLE).select("file", "first", "text")
    return whole.unionByName(joined)


def array_as_lines(spark: SparkSession, path: str, split_bytes: int | None = None) -> str:
    """A folder with the objects of JSON array files as lines, which any JSON reader splits.

    Arrays of objects only; line breaks between tokens become blanks. ``split_bytes`` narrows the
    ranges for this job.
    """
    wanted = {} if split_bytes is None else {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.files.openCostInBytes": "0"}
    with settings(spark, wanted):
        records = split_records(spark, path, ARRAY)
        folder = scratch_folder(spark)
        line = F.regexp_replace(F.col("text").cast("string"), r"[\r\n]", " ")
        records.select(line.alias("value")).write.text(folder)
    return folder
