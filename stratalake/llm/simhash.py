"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at three or fewer differing bits, so in one of the two halves of 31 bits
(two bits are left over) at most one bit differs. The anchors are, per half, the words of the Hamming
code of length 31: a perfect covering code, each pattern lies within one bit of exactly one of its
2**26 words. Two patterns at distance one lie within 1 + 1 bits of the anchor of either, so each
fingerprint is sent to all anchors within two bits (16 on average a half) and fingerprints that meet
at an anchor are compared in full. No link can be missed and a random pair meets with a probability
of about 2**-22 a half.

Equal fingerprints are one before anything is sent. Fingerprints of an anchor are compared in blocks;
an anchor with more than a block of them is split into a triangle of block pairs, so no task gets
an unbounded group. A comparison emits links that span what it found linked, not all pairs.

Defined cases: a NULL or blank text has no shingle and the fingerprint zero, which links like any
other; repeated rows share a component; NULL ids belong to the component of their fingerprint; an
empty table gives an empty result; only the id and the text column are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_batches, mix, stored, utf8, width
from stratalake.llm.components import components

SHINGLE, BITS = 3, 3
#: Fingerprints that are compared with each other in one piece.
BLOCK = 2048

_LENGTH = 31
#: Groups up to this size are compared together by shifting them against themselves.
_SMALL = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of word shingles, repeats included; A-Z count as a-z."""
    words = text.lower().split()  # of bytes: A-Z only
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(word) + 1 for word in words])
    count = max(1, len(words) - shingle + 1)
    begins = np.concatenate(([0], ends))[:count].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones, bits = np.zeros(64, np.int64), np.uint8
    for at in range(0, count, 65536):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(
            begins[at:at + 65536], stops[at:at + 65536])], "<u8")
        ones += np.unpackbits(hashes.view(bits).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > count, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(id, print): one row per document, the fingerprint as a signed long."""

    def build(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [fingerprint(text, shingle) for text in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(found, pa.int64())], names=["id", "print"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(arrow_batches(build), source.select("id").schema.add("print", "long"))


def _syndromes() -> np.ndarray:
    """The syndrome of bit ``i`` of a half is ``i + 1``; here for each of four bytes of a half."""
    table = np.zeros((4, 256), np.uint8)
    for byte in range(4):
        for bit in range(8):
            if 8 * byte + bit < _LENGTH:
                table[byte, np.arange(256) >> bit & 1 == 1] ^= 8 * byte + bit + 1
    return table


def anchors(prints: np.ndarray) -> Iterator[np.ndarray]:
    """For each of the two halves and each place the anchors within two bits of the prints.

    A pattern with syndrome ``s`` reaches the code by flipping the bits of a set whose numbers
    combine to ``s``: none if ``s`` is 0; one, ``s``; two, ``i`` and ``i ^ s``. An anchor is coded as
    the half times 2**31 plus the code word; -1 stands for no anchor.
    """
    table = _syndromes()
    for half in range(2):
        part = prints >> np.uint64(32 * half) & np.uint64((1 << _LENGTH) - 1)
        byte = part.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :4]
        syndrome = table[np.arange(4), byte]
        syndrome = np.bitwise_xor.reduce(syndrome, axis=1).astype(np.int64)
        base = part.astype(np.int64)

        def flipped(numbers: np.ndarray, base=base) -> np.ndarray:
            return base ^ np.where(numbers > 0, np.int64(1) << np.maximum(numbers - 1, 0), 0)

        code = half << _LENGTH
        yield code | flipped(syndrome)  # the pattern itself or its only neighbour in the code
        for i in range(1, _LENGTH + 1):
            other = i ^ syndrome
            pair = base ^ (np.int64(1) << (i - 1)) ^ np.where(
                other > 0, np.int64(1) << np.maximum(other - 1, 0), 0)
            # Each pair once; with syndrome 0 no two flips lead to the code.
            yield np.where((syndrome > 0) & (other > i), code | pair, np.int64(-1))


def _placed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    prints = batch.column("print").to_numpy(zero_copy_only=False).view("<u8")
    for reached in anchors(prints):
        at = np.flatnonzero(reached >= 0)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(reached[at]), pa.array(prints[at].view("<i8"))],
                names=["anchor", "print"])


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links a-b as few as join the same values; the others say nothing new."""
    values, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent, kept = list(range(len(values))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (x, y) in enumerate(zip(places[:len(a)].tolist(), places[len(a):].tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return a[kept], b[kept]


def _links(prints: np.ndarray, group: np.ndarray, side: np.ndarray, bits: int):
    """Spanning links of whole groups. ``side`` 0: all with all; else 1 with 2."""
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(begin, len(group)))
    small = np.repeat((size <= _SMALL) & (side[begin] == 0), size)
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    own, of = prints[small], group[small]
    for lag in range(1, min(_SMALL, int(size.max()))):
        hit = (of[lag:] == of[:-lag]) & (np.bitwise_count(own[lag:] ^ own[:-lag]) <= bits)
        a.append(own[:-lag][hit])
        b.append(own[lag:][hit])
    for at, n in zip(begin.tolist(), size.tolist()):
        if small[at]:
            continue
        one, half = prints[at:at + n], side[at:at + n]
        left, right = (one, one) if half[0] == 0 else (one[half == 1], one[half == 2])
        for row in range(0, len(left), 256):
            x, y = np.nonzero(
                np.bitwise_count(left[row:row + 256, None] ^ right[None, :]) <= bits)
            p, q = spanning(left[row + x], right[y])
            a.append(p)
            b.append(q)
    return spanning(np.concatenate(a), np.concatenate(b))


def _compare(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by group, where a group may go on in the next batch."""
    rest = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int8)]

    def linked(prints, group, side) -> Iterator[pa.RecordBatch]:
        if len(prints):
            a, b = _links(prints, group, side, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view("<i8")), pa.array(b.view("<i8"))], names=["a", "b"])

    for batch in batches:
        keys = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("anchor", "i", "j")]
        group = np.ascontiguousarray(np.stack(keys, axis=1).astype("<i8"))
        # The group's number only has to differ from that of its neighbour.
        number = mix(group[:, 0].view("<u8")) ^ mix((group[:, 1] << 32 | group[:, 2]).view("<u8"))
        rows = [np.concatenate(x) for x in zip(rest, (
            batch.column("print").to_numpy(zero_copy_only=False).view("<u8"),
            number.view("<i8"), batch.column("side").to_numpy(zero_copy_only=False)))]
        if not len(rows[1]):
            continue
        other = np.flatnonzero(rows[1] != rows[1][-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        yield from linked(*(x[:cut] for x in rows))
        rest = [x[cut:] for x in rows]
    yield from linked(*rest)


def links(prints: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints that span all those of ``bits`` or fewer bits."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with one differing bit each cover at most three bits")
    placed = prints.mapInArrow(
        lambda batches: (x for batch in batches if batch.num_rows for x in _placed(batch)),
        "anchor long, print long")
    # Most anchors have one fingerprint, and those end here. The others grow faster than the corpus,
    # and Spark sizes them by the file of the fingerprints: they are never built in memory.
    sizes = placed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(
        "anchor", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    met = placed.join(sizes.hint("merge"), "anchor").withColumn("own", own).select(
        "anchor", "print", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    grouped = met.select(
        "anchor", "print", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
        F.when(F.col("own") == F.col("with"), 0).when(F.col("own") < F.col("with"), 1).otherwise(
            2).cast("byte").alias("side"))
    return grouped.repartition(width(prints), "anchor", "i", "j").sortWithinPartitions(
        "anchor", "i", "j").mapInArrow(lambda batches: _compare(batches, bits), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    bits: int = BITS,
) -> DataFrame:
    """Per document: id, ``print`` (signed long) and ``component_id``, the smallest id reachable."""
    found = stored(fingerprints(docs, id_col, text_col, shingle))
    first = found.groupBy("print").agg(F.min("id").alias("first"))
    member = components(links(first.select("print"), bits))
    named = first.join(member, first["print"] == member["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = named.join(smallest, "component").select("print", "component_id")
    # The ids and prints of all documents take far less room in a file than in memory.
    return found.join(by_print.hint("merge"), "print").select(
        F.col("id").alias(id_col), "print", "component_id")


def survivors(
    docs: DataFrame, near: Callable[[DataFrame, str, str], DataFrame], id_col: str, text_col: str
) -> DataFrame:
    """One document with all its columns for each component that ``near`` finds.

    The survivor has the smallest id, a NULL one comes last, then the smallest hashes of its text:
    an id need not be there, nor name one text. Of rows that repeat both, one stays.
    """
    text = F.col(text_col)
    key = F.struct(
        F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"),
        F.xxhash64(text).alias("content"), F.xxhash64(F.lit(7), text).alias("content2"))
    judged = near(docs.select(key.alias("key"), text.alias("text")), "key", "text")
    kept = judged.select(F.col("component_id").alias("one")).distinct()
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), key.alias("key"))
    same = [F.col(f"key.{name}").eqNullSafe(F.col(f"one.{name}"))
            for name in ("id", "content", "content2")]
    return rows.join(kept, same, "left_semi").dropDuplicates(["key"]).select(
        *(F.col("row")[name].alias(name) for name in docs.columns))


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    bits: int = BITS,
) -> DataFrame:
    """One document with all its columns for each component, see ``survivors``."""
    return survivors(
        docs, lambda rows, key, text: near_duplicates(rows, key, text, shingle, bits),
        id_col, text_col)
