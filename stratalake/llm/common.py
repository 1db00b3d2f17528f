"""Shared pieces: word rules, hashing of words and word windows, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import scratch_folder

#: A word, in Spark's and in Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that separate words; every byte of a longer UTF-8 character is outside this set.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BYTE_BASE, _WORD_BASE, _WIDE_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA24BAED4963EE407
_BYTE_CODES = np.random.default_rng(20240401).integers(1, 2**63, 256, dtype=np.uint64)
_ONE = np.uint64(1)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """As ``stored``, in buckets of ``key``: groups of it are then formed without a shuffle.

    Only the catalogue entry is temporary; the frame keeps the files and their layout.
    """
    spark, name = df.sparkSession, f"llm_{uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch_folder(spark)).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolves the table while its entry is there
    spark.sql(f"DROP TABLE {name}")
    return table


def sampled(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most ``rows`` rows, the same ones every time: one for each bucket of the hash of ``by``.

    It is one aggregation that keeps a row per bucket in every task, so nothing is gathered whose
    size follows the input. Of a bucket the row with the smallest hash stays, then the smallest row.
    """
    key, row = F.xxhash64(*by), F.struct(*(F.col(name) for name in df.columns))
    kept = df.select(key.alias("key"), row.alias("row")).groupBy(
        F.pmod("key", F.lit(rows)).alias("bucket")).agg(F.min(F.struct("key", "row")).alias("least"))
    return kept.select("least.row.*")


def width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def digest(column) -> F.Column:
    """Lowercase hex SHA-256 of a text in UTF-8; NULL counts as empty."""
    return F.sha2(F.coalesce(column, F.lit("")).cast("binary"), 256)


def arrow_batches(
    build: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], max_bytes: int = 4 << 20
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``build`` over slices of about ``max_bytes``, one row at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = max(1, int(batch.num_rows * max_bytes // max(1, batch.nbytes)))
            for begin in range(0, batch.num_rows, rows):
                yield from build(batch.slice(begin, rows))

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=8)
def _powers_of(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    return _powers_of(base, 1 << max(16, (n - 1).bit_length()))[:n]


def _segments(values: np.ndarray, base: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ``values[begin:end]`` for many ranges, independent of the place."""
    n = len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n), out=prefix[1:], dtype=np.uint64)
    inverse = _powers(pow(base, -1, 1 << 64), n + 1)
    return (prefix[end] - prefix[begin]) * inverse[begin]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and the number of words of each text."""
    hashes, counts = [np.zeros(0, np.uint64)], []
    group: list[bytes] = []

    def flush() -> None:
        if not group:
            return
        data = np.frombuffer(b"\n".join([*group, b""]), np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        begin, end = edges[0::2], edges[1::2]
        ends = np.cumsum([len(t) + 1 for t in group])
        counts.append(np.diff(np.searchsorted(begin, np.concatenate(([0], ends)))))
        if len(begin):
            value = _segments(_BYTE_CODES[data], _BYTE_BASE, begin, end)
            hashes.append(mix(value + (end - begin).astype(np.uint64) * np.uint64(_WIDE_BASE)))
        group.clear()

    size = 0
    for text in texts:
        if group and size + len(text) > 1 << 20:
            flush()
            size = 0
        group.append(text)
        size += len(text) + 1
    flush()
    return np.concatenate(hashes), np.concatenate([np.zeros(0, np.int64), *counts])


def window_starts(counts: np.ndarray, words: int) -> np.ndarray:
    """Positions in the joined word sequence at which a whole window of one text begins."""
    ends = np.cumsum(counts)
    last = np.repeat(ends, counts) - words
    at = np.arange(len(last))
    return at[at <= last]


def window_hashes(
    hashes: np.ndarray, begin: np.ndarray, words: int, wide: bool = False
) -> np.ndarray:
    """Hash of ``words`` words from each start; ``wide`` gives a second, independent hash."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    base = _WIDE_BASE if wide else _WORD_BASE
    return mix(_segments(hashes, base, begin, begin + words))


def covered(begin: np.ndarray, words: int, total: int) -> np.ndarray:
    """Mask of the positions that lie in a window starting at one of ``begin`` (no repeats)."""
    edge = np.zeros(total + 1, np.int32)
    edge[begin] += 1
    edge[begin + words] -= 1
    return np.cumsum(edge[:-1]) > 0


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; NULL becomes empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [value or b"" for value in column.to_pylist()]
