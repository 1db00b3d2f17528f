"""Removal of repeated passages: fixed-block anchors, rolling probes and maximal exact repeats.

A passage is a window of ``window`` words whose sequence starts at two or more places. Any such
window holds a whole block of ``(window + 1) // 2`` words that begins at a multiple of that length in
its document. So the blocks are the index, and every rolling window of the block's length is a probe.

1. Texts go to chunks by a hash of their id. Each chunk sends the distinct hashes of its probes to
   buckets, marked if they are also a block and if they occur twice.
2. A bucket answers with the hashes that have a block and a second place. These are the hits.
3. Around its hits a chunk tries all windows of full length and sends 95 bits of hash of each to
   buckets, which answer with those that start at two or more places.
4. Adjacent repeated windows join to maximal repeats, whose words the chunk removes.

A chunk sends a hash once however often it occurs, so a passage that a third of the corpus holds is
one entry per chunk, and no pairs are ever made. Entries travel as compressed byte planes.
Steps 1 and 2 only choose where to look, and a clash of their shortened hashes costs time alone.

Defined cases: a NULL or blank text has no words and an empty rest; repeated rows repeat each other
and lose what is longer than the window; NULL ids form one chunk; a text shorter than the window
stays; an empty table gives an empty result; only the id and the text column are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import (
    covered, utf8, width, window_hashes, window_starts, word_hashes)

WINDOW = 35
#: Bytes of text that a chunk is meant to hold.
CHUNK_BYTES = 4 << 20

_ENTRIES = "chunk long, bucket int, data binary"


def _pack(planes: np.ndarray) -> bytes:
    """A matrix of bytes, one column after the other."""
    return zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def _unpack(data: bytes, columns: int) -> np.ndarray:
    return np.ascontiguousarray(
        np.frombuffer(zstandard.decompress(data), np.uint8).reshape(columns, -1).T)


def _bytes_of(values: np.ndarray, count: int) -> np.ndarray:
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :count]


def _number(planes: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(planes), 8), np.uint8)
    wide[:, :planes.shape[1]] = planes
    return wide.reshape(-1).view("<u8")


class _Chunk:
    """The words of a chunk's texts as hashes, with the windows that the steps need."""

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.block = window, (window + 1) // 2
        self.hashes, self.counts = word_hashes(texts)
        self.begins = np.cumsum(self.counts) - self.counts

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and hashes of all rolling windows, and which of them are anchors."""
        at = window_starts(self.counts, self.block)
        base = np.repeat(self.begins, self.counts)[at]
        return at, window_hashes(self.hashes, at, self.block), (at - base) % self.block == 0

    def near(self, hits: np.ndarray) -> np.ndarray:
        """Starts of the full windows whose first half holds a hit."""
        total = len(self.hashes)
        edge = np.zeros(total + 1, np.int32)
        np.add.at(edge, np.maximum(0, hits - self.block + 1), 1)
        edge[hits + 1] -= 1
        at = window_starts(self.counts, self.window)
        return at[np.cumsum(edge[:-1])[at] > 0]

    def wide(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 bits and 31 more, independent ones of the full windows."""
        return (window_hashes(self.hashes, at, self.window), window_hashes(
            self.hashes, at, self.window, wide=True) & np.uint64((1 << 31) - 1))


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % buckets


def _sent(chunk, bucket: np.ndarray, planes: np.ndarray) -> pa.Table:
    """Rows sorted by bucket as one blob for each."""
    used, first = np.unique(bucket, return_index=True)
    blobs = [_pack(part) for part in np.split(planes, first[1:])] if len(used) else []
    return pa.table({"chunk": pa.array([chunk] * len(used), pa.int64()),
                     "bucket": pa.array(used, pa.int32()), "data": pa.array(blobs, pa.binary())})


def _probe_key(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 38 further bits of a probe."""
    return _bucket_of(hashes, buckets), hashes & np.uint64((1 << 38) - 1)


def _send_probes(key: tuple, rows: pa.Table, window: int, buckets: int) -> pa.Table:
    _, hashes, anchor = _Chunk(utf8(rows.column("text").combine_chunks()), window).probes()
    bucket, value = _probe_key(hashes, buckets)
    order = np.lexsort((value, bucket))
    bucket, value, anchor = bucket[order], value[order], anchor[order]
    if not len(order):
        return _sent(None, bucket, np.zeros((0, 5), np.uint8))
    new = np.concatenate(([True], (np.diff(bucket) != 0) | (np.diff(value) != 0)))
    first = np.flatnonzero(new)
    twice = np.diff(np.append(first, len(new))) > 1
    marked = np.logical_or.reduceat(anchor, first)
    flags = marked.astype(np.uint64) << np.uint64(39) | twice.astype(np.uint64) << np.uint64(38)
    return _sent(key[0].as_py(), bucket[first], _bytes_of(value[first] | flags, 5))


def _answer_probes(rows: pa.Table) -> pa.Table:
    """Per chunk those of its values that have an anchor and a second place."""
    parts = [_number(_unpack(x, 5)) for x in rows.column("data").to_pylist()]
    values = np.concatenate(parts)
    low = np.uint64((1 << 38) - 1)
    distinct, inverse, times = np.unique(values & low, return_inverse=True, return_counts=True)
    anchor, twice = np.zeros(len(distinct), bool), times > 1
    anchor[inverse[values >> np.uint64(39) & np.uint64(1) > 0]] = True
    twice[inverse[values >> np.uint64(38) & np.uint64(1) > 0]] = True
    return _answers(rows, [part & low for part in parts], (anchor & twice)[inverse], 5)


def _answers(rows: pa.Table, parts: list[np.ndarray], hit: np.ndarray, size: int) -> pa.Table:
    out, at = [], 0
    for part in parts:
        own = part[hit[at:at + len(part)]]
        out.append(None if not len(own) else _pack(
            _bytes_of(own, size) if own.ndim == 1 else own))
        at += len(part)
    table = pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
                      "data": pa.array(out, pa.binary())})
    return table.filter(table.column("data").is_valid())


def _values(answers: pa.Table, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and byte rows of all answers to a chunk."""
    parts = [_unpack(x, columns) for x in answers.column("data").to_pylist()]
    bucket = np.repeat(answers.column("bucket").to_numpy(), [len(p) for p in parts])
    return bucket.astype(np.int64), np.concatenate([np.zeros((0, columns), np.uint8), *parts])


def _send_windows(
    key: tuple, rows: pa.Table, answers: pa.Table, window: int, buckets: int
) -> pa.Table:
    none = _sent(None, np.zeros(0, np.int64), np.zeros((0, 12), np.uint8))
    if not rows.num_rows or not answers.num_rows:
        return none
    chunk = _Chunk(utf8(rows.column("text").combine_chunks()), window)
    at, hashes, _ = chunk.probes()
    bucket, planes = _values(answers, 5)
    # One number for both parts; a clash only adds a place to look at.
    mark = lambda b, v: v ^ (b.astype(np.uint64) << np.uint64(38))
    hits = at[np.isin(mark(*_probe_key(hashes, buckets)), mark(bucket, _number(planes)))]
    first, second = chunk.wide(chunk.near(hits))
    if not len(first):
        return none
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    begin = np.flatnonzero(np.concatenate(
        ([True], (np.diff(first) != 0) | (np.diff(second) != 0))))
    twice = np.diff(np.append(begin, len(first))) > 1
    first, second = first[begin], second[begin] | twice.astype(np.uint64) << np.uint64(31)
    bucket = _bucket_of(first, buckets)
    order = np.argsort(bucket, kind="stable")
    planes = np.hstack([_bytes_of(first, 8), _bytes_of(second, 4)])
    return _sent(key[0].as_py(), bucket[order], planes[order])


def _answer_windows(rows: pa.Table) -> pa.Table:
    """Per chunk the first 64 bits of its windows that start at two or more places."""
    parts = [_unpack(x, 12) for x in rows.column("data").to_pylist()]
    planes = np.concatenate(parts)
    first, second = _number(planes[:, :8]), _number(planes[:, 8:])
    value, twice = second & np.uint64((1 << 31) - 1), second >> np.uint64(31) > 0
    order = np.lexsort((value, first))
    new = np.concatenate((
        [True], (np.diff(first[order]) != 0) | (np.diff(value[order]) != 0)))
    group = np.cumsum(new) - 1
    repeated = np.bincount(group) > 1
    repeated[group[twice[order]]] = True
    hit = np.zeros(len(planes), bool)
    hit[order] = repeated[group]
    return _answers(rows, [part[:, :8] for part in parts], hit, 8)


def _cut(rows: pa.Table, answers: pa.Table, window: int) -> pa.Table:
    """The chunk's documents without the words of repeated windows."""
    texts = utf8(rows.column("text").combine_chunks())
    counts = np.array([len(text.split()) for text in texts], np.int64)
    gone = np.zeros(int(counts.sum()), bool)
    if answers.num_rows:
        chunk = _Chunk(texts, window)
        at = window_starts(chunk.counts, window)
        # A chunk's own windows number far too few for one to meet a wrong 64 bits.
        repeated = _number(_values(answers, 8)[1])
        found = np.isin(window_hashes(chunk.hashes, at, window), repeated)
        gone = covered(at[found], window, len(gone))
    kept, removed, begin = [], [], 0
    for text, count in zip(texts, counts.tolist()):
        own = gone[begin:begin + count]
        begin += count
        words = text.split()
        if own.any():
            words = [words[i] for i in np.flatnonzero(~own).tolist()]
        kept.append(b" ".join(words))
        removed.append(int(own.sum()))
    return pa.table({
        "id": rows.column("id"), "n_words": pa.array(counts, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def chunks_for(docs: DataFrame, text_col: str, chunk_bytes: int) -> int:
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, -(-size // chunk_bytes))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed`` and ``kept_text``, its words without repeats."""
    chunks, buckets = chunks_for(docs, text_col, chunk_bytes), 2 * width(docs)
    texts = docs.select(
        F.pmod(F.xxhash64(id_col), F.lit(chunks)).cast("long").alias("chunk"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text")).repartition(
            min(chunks, 4 * width(docs)), "chunk")
    probes = texts.groupBy("chunk").applyInArrow(
        lambda key, rows: _send_probes(key, rows, window, buckets), _ENTRIES)
    hits = probes.groupBy("bucket").applyInArrow(_answer_probes, _ENTRIES)
    # The three steps read the same columns of the texts, and so share one exchange of them.
    windows = texts.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(
        lambda key, rows, answers: _send_windows(key, rows, answers, window, buckets), _ENTRIES)
    repeats = windows.groupBy("bucket").applyInArrow(_answer_windows, _ENTRIES)
    schema = texts.select("id").schema.add("n_words", "long").add("n_removed", "long").add(
        "kept_text", "string")
    return texts.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(
        lambda rows, answers: _cut(rows, answers, window), schema).withColumnRenamed("id", id_col)
