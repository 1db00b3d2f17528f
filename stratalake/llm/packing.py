"""Packing tokenised documents into fixed-size sequences by a linear grouping scheme.

Large pieces are sorted by length and cut into groups of equal cardinality, each rounded up to its
longest. Sequences of rounded sizes ("configurations") are optimised as a linear program by column
generation, used as often as it says rounded down, and once more for the fractions. Actual pieces
then take the places of the rounded ones: each place goes to the longest piece left that fits beside
the pieces before it and the rounded sizes after it, so room that rounding opened is used at once. The
small pieces go in by best fit, longest first. Where a piece counts as large is tried at a few shares
of the capacity, and the plan with the fewest sequences is taken.

All of this works on the counts per length. There are at most ``capacity`` lengths, so what reaches
the driver and the plan that goes back are bounded whatever the number of documents. Spark ranks the
pieces of each length, in salted parts so that a frequent length is no single task, and looks up
each rank's place in the plan.

Defined cases: a NULL text is empty and still holds the end id; repeated rows are packed each; an
empty table gives an empty result; only the id and the text column are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.bpe import ChunkIds, per_chunk
from stratalake.llm.common import stored, width

CAPACITY, END_ID = 2048, 0
#: Pieces longer than such a share of a sequence are grouped; the rest is filled in by best fit.
LARGE_SHARES, GROUPS = (1 / 3, 1 / 4), 96


def pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of all documents, cut only beyond ``capacity``."""
    end = np.array([end_id], "<u4")

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, rows = ChunkIds(texts, answers), []
        for row, at in enumerate(chunk.places()):
            ids = np.concatenate([chunk.of(at), end])
            for piece, begin in enumerate(range(0, len(ids), capacity)):
                part = ids[begin:begin + capacity]
                rows.append((row, piece, begin, len(part), zlib.crc32(part.tobytes())))
        place, *values = zip(*rows)
        return pa.table({
            "id": chunk.owners.take(pa.array(place, pa.int64())),
            "piece": pa.array(values[0], pa.int32()), "start": pa.array(values[1], pa.int64()),
            "length": pa.array(values[2], pa.int64()),
            "ids_crc32": pa.array(values[3], pa.int64())})

    schema = docs.select(F.col(id_col).alias("id")).schema.add("piece", "integer")
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, "long")
    return per_chunk(docs, tokenizer_path, id_col, text_col, cut, schema)


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of greatest worth that fits (an unbounded knapsack)."""
    value, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for k in np.argsort(-worth / sizes):
        size = int(sizes[k])
        for _ in range(capacity // size):
            gain = value[:-size] + worth[k]
            better = gain > value[size:] + 1e-12
            if not better.any():
                break
            value[size:][better] = gain[better]
            taken[size:][better] = k
    pattern, room = np.zeros(len(sizes)), int(np.argmax(value))
    while taken[room] >= 0:
        pattern[taken[room]] += 1
        room -= sizes[taken[room]]
    return pattern


def configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400
) -> tuple[np.ndarray, np.ndarray]:
    """Columns of a linear program that covers ``demand`` with fewest sequences, and their use.

    Revised simplex with column generation, started with one size per sequence.
    """
    basis = np.diag(np.maximum(1, capacity // sizes).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        use = inverse @ demand
        pattern = _best_pattern(sizes, inverse.sum(axis=0), capacity)
        if inverse.sum(axis=0) @ pattern <= 1 + 1e-9:
            break
        direction = inverse @ pattern
        rising = direction > 1e-9
        ratio = np.where(rising, use / np.where(rising, direction, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = pattern
    return basis, np.linalg.inv(basis) @ demand


class Plan:
    """Places for the pieces, numbered from the longest to the shortest.

    A run gives the items ``first .. first + count - 1`` places in the sequences from ``bin`` on,
    ``each`` items to a sequence, the first one at ``offset``.
    """

    def __init__(self, counts: dict[int, int], capacity: int, groups: int = GROUPS,
                 large_share: float = LARGE_SHARES[0]):
        self.capacity, self.bins = capacity, 0
        #: Pieces that are grouped, and those of them that have a place in a configuration.
        self.large = self.configured = 0
        self.lengths = np.array(sorted(counts, reverse=True), np.int64)
        self.ends = np.cumsum([counts[n] for n in self.lengths])
        self.begins = self.ends - [counts[n] for n in self.lengths]
        self.runs: list[tuple[int, int, int, int, int]] = []
        #: (room left, first sequence, sequences, offset), sorted: best fit is the next one up.
        self.open: list[tuple[int, int, int, int]] = []
        whole = int(self.ends[self.lengths == capacity].max(initial=0))
        large = max(whole, int(self.ends[self.lengths > capacity * large_share].max(initial=0)))
        self._add(0, whole, capacity, 1, 0)
        left = self._grouped(whole, large, groups) if large > whole else []
        for first, last in [*left, (large, int(self.ends[-1]) if len(self.ends) else 0)]:
            for begin, end, length in self._steps(first, last):
                self._best_fit(begin, end, length)

    def _steps(self, first: int, last: int) -> Iterator[tuple[int, int, int]]:
        """The items of [first, last) as ranges of one length."""
        while first < last:
            k = int(np.searchsorted(self.ends, first, side="right"))
            end = min(last, int(self.ends[k]))
            yield first, end, int(self.lengths[k])
            first = end

    def _add(self, first: int, count: int, length: int, each: int, start: int) -> None:
        if count:
            self.runs.append((first, count, start, each, 0))
            self.bins += -(-count // each)

    def _grouped(self, first: int, last: int, groups: int) -> list[tuple[int, int]]:
        """Places the items by configurations; returns the ranges of items that are left."""
        edges = np.unique(np.linspace(first, last, groups + 1).round().astype(np.int64))
        longest = self.lengths[np.searchsorted(self.ends, edges[:-1], side="right")]
        # Groups that round up to one size are one group.
        sizes, group = np.unique(longest, return_inverse=True)
        demand = np.bincount(group, np.diff(edges), len(sizes))
        columns, use = configurations(sizes, demand, self.capacity)
        columns, whole = columns.T.round().astype(int), np.floor(use + 1e-9)
        #: The items of each length that have no place yet, and those lengths in order.
        self.free = {n: [begin, end] for begin, end, n in self._steps(first, last)}
        self.left, self.large = sorted(self.free), last - first
        for k in np.argsort(-(columns @ sizes), kind="stable"):  # the fullest ones first
            self._configured(np.repeat(sizes, columns[k])[::-1].tolist(), int(whole[k]))
        for k in np.argsort(whole - use, kind="stable"):
            if use[k] - whole[k] > 1e-6:
                self._configured(np.repeat(sizes, columns[k])[::-1].tolist(), 1)
        return sorted((begin, end) for begin, end in self.free.values() if begin < end)

    def _configured(self, slots: list[int], times: int) -> None:
        """Actual items for the slots of ``times`` sequences, as far as there are any that fit."""
        while times > 0:
            room, after, taken, chosen = self.capacity, sum(slots), {}, []
            for slot in slots:
                after -= slot
                at = bisect_right(self.left, room - after) - 1
                while at >= 0 and self._count(self.left[at]) <= taken.get(self.left[at], 0):
                    at -= 1
                if at < 0:
                    return
                chosen.append(self.left[at])
                taken[chosen[-1]] = taken.get(chosen[-1], 0) + 1
                room -= chosen[-1]
            # The same lengths serve as many sequences as there are items of each.
            count = min(times, *(self._count(n) // each for n, each in taken.items()))
            offset = 0
            for n in chosen:
                self.runs.append((self.free[n][0], count, self.bins, 1, offset))
                self.free[n][0] += count
                offset += n
            self.left = [n for n in self.left if n not in taken or self._count(n)]
            self._opened(self.bins, count, offset)
            self.bins += count
            self.configured += count * len(chosen)
            times -= count

    def _count(self, length: int) -> int:
        begin, end = self.free[length]
        return end - begin

    def _opened(self, first: int, count: int, offset: int) -> None:
        if count and offset < self.capacity:
            insort(self.open, (self.capacity - offset, first, count, offset))

    def _best_fit(self, begin: int, end: int, length: int) -> None:
        while begin < end:
            at = bisect_left(self.open, (length,))
            if at == len(self.open):
                each = self.capacity // length
                room, first, count, offset = self.capacity, self.bins, -(-(end - begin) // each), 0
                self.bins += count
            else:
                room, first, count, offset = self.open.pop(at)
            each = room // length
            full = min(count, (end - begin) // each)
            if full:
                self.runs.append((begin, full * each, first, each, offset))
                self._opened(first, full, offset + each * length)
                begin += full * each
            if full < count:
                rest = min(end - begin, each)
                if rest:
                    self.runs.append((begin, rest, first + full, each, offset))
                    self._opened(first + full, 1, offset + rest * length)
                    begin, full = begin + rest, full + 1
                self._opened(first + full, count - full, offset)


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan with the fewest sequences for so many pieces of each length."""
    return min((Plan(counts, capacity, large_share=share) for share in LARGE_SHARES),
               key=lambda plan: plan.bins)


def packed(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id and offset."""
    cut = stored(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id))
    # The salts of a frequent length are so many tasks; their number follows the shuffle width.
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"),
                                           F.lit(4 * width(docs))))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {row["length"]: row["n"] for row in parts.groupBy("length").agg(
        F.sum("n").alias("n")).collect()}  # one row per length, at most ``capacity``
    plan = best_plan(counts, capacity)
    lengths = plan.lengths
    longer = dict(zip(lengths.tolist(), plan.begins.tolist()))
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1))
    offsets = parts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32"))
    ranked = salted.withColumn("rank", rank - 1).join(offsets, ["length", "salt"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("at"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            item = batch.column("at").to_numpy(zero_copy_only=False) + np.array(
                [longer[n] for n in length.tolist()], np.int64)
            first, _, start, each, offset = runs[
                np.searchsorted(runs[:, 0], item, side="right") - 1].T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("id", "piece", "start", "length", "ids_crc32")),
                 pa.array(start + (item - first) // each),
                 pa.array(offset + (item - first) % each * length)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = ranked.drop("at").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema).withColumnRenamed("id", id_col)
