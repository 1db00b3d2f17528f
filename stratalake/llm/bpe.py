"""BPE encoding and decoding by a table of distinct words.

Words are the runs between ASCII white space; no merge, normalisation or added token of the
tokenizer crosses it, so a text's ids are the ids of its words in order. A text is split into words
on Spark, each chunk of texts lists its distinct words, and the texts keep only the places of their
words in that list. Every distinct word of the corpus is encoded once, its ids are joined back to the
chunks' lists and put into the texts by position. Decoding joins each distinct word's ids to the
table of id and piece. The pieces are one row per id of the vocabulary, so that table is bounded.

Defined cases: a NULL or blank text has no ids; repeated rows and NULL ids keep their rows; an
empty table gives an empty result; only the id and the text column are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from stratalake.llm.common import stored_by, utf8, width

#: Texts of about so many bytes share one list of distinct words.
CHUNK_BYTES = 12 << 20


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def encode_words(path: str, words: list[bytes]) -> list[np.ndarray]:
    """The ids of each word; the same as those of the word inside any text."""
    found = tokenizer(path).encode_batch_fast(
        [word.decode() for word in words], add_special_tokens=False)
    return [np.array(one.ids, "<u4") for one in found]


@lru_cache(maxsize=2)
def piece_table(path: str) -> list[bytes]:
    """The piece of every id; decoding joins pieces by a space, as the vocabulary has no decoder."""
    loaded = tokenizer(path)
    if loaded.decoder is not None:
        raise ValueError("only vocabularies without a decoder step are supported")
    return [(loaded.id_to_token(i) or "").encode() for i in range(loaded.get_vocab_size())]


def _packed_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, one byte plane after the other, compressed."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


_COLUMNS = ["chunk", "bucket", "ids", "counts", "places", "words"]


def _chunk_rows(
    ids: list[pa.Array], texts: list[bytes], buckets: int, kind: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """One row of the texts as places of their words, then the distinct words by bucket."""
    known: dict[bytes, int] = {}
    places, counts, name = [], [], hashlib.blake2b(digest_size=8)
    for text in texts:
        name.update(len(text).to_bytes(8, "little") + text)
        words = text.split()
        for word in words:
            if word not in known:
                known[word] = len(known)
        places.append(np.array([known[word] for word in words], "<u4"))
        counts.append(len(words))
    chunk, own = int.from_bytes(name.digest(), "little", signed=True), pa.concat_arrays(ids)
    yield pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.nulls(1, pa.int32()),
         pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own, type=kind),
         pa.array([_packed_ints(np.array(counts, "<u4"))], pa.binary()),
         pa.array([_packed_ints(np.concatenate(places))], pa.binary()), pa.nulls(1, pa.binary())],
        names=_COLUMNS)
    if not known:
        return
    words = np.array(list(known), object)
    bucket = np.fromiter(map(zlib.crc32, known), np.int64, len(known)) % buckets
    order = np.argsort(bucket, kind="stable")
    used, begin = np.unique(bucket[order], return_index=True)
    parts, n = np.split(order, begin[1:]), len(used)
    yield pa.RecordBatch.from_arrays(
        [pa.array([chunk] * n, pa.int64()), pa.array(used, pa.int32()), pa.nulls(n, kind),
         pa.nulls(n, pa.binary()),
         pa.array([_packed_ints(np.diff(part, prepend=0)) for part in parts], pa.binary()),
         pa.array([zstandard.compress(b" ".join(words[part]), 3) for part in parts], pa.binary())],
        names=_COLUMNS)


def _chunked(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Rows of texts (``bucket`` is NULL) and rows of distinct words, both under their chunk.

    The chunk's number is a hash of its texts. Equal chunks therefore share a number, a word list
    and places, and may be mixed freely.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            kind = pa.list_(pa.field("element", batch.column("id").type))
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                more = utf8(part.column("text"))
                ids.append(part.column("id"))
                texts += more
                size += sum(map(len, more))
                if size > CHUNK_BYTES:
                    yield from _chunk_rows(ids, texts, buckets, kind)
                    ids, texts, size = [], [], 0
        if texts:
            yield from _chunk_rows(ids, texts, buckets, kind)

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    binary = T.BinaryType()
    schema = T.StructType().add("chunk", "long").add("bucket", "integer").add(
        "ids", T.ArrayType(source.schema["id"].dataType))
    for name in ("counts", "places", "words"):
        schema = schema.add(name, binary)
    return source.mapInArrow(run, schema)


def _encode_bucket(rows: pa.Table, path: str) -> pa.Table:
    """Encodes every distinct word of a bucket once and answers all chunks that hold it."""
    lists = [zstandard.decompress(data).split(b" ") for data in rows.column("words").to_pylist()]
    known: dict[bytes, int] = {}
    for words in lists:
        for word in words:
            if word not in known:
                known[word] = len(known)
    distinct, found = list(known), []
    for begin in range(0, len(distinct), 10_000):
        found += encode_words(path, distinct[begin:begin + 10_000])
    sizes, ids = [], []
    for words in lists:
        own = [found[known[word]] for word in words]
        sizes.append(_packed_ints(np.array([len(x) for x in own], "<u4")))
        ids.append(_packed_ints(np.concatenate(own)))
    return pa.table({"chunk": rows.column("chunk"), "places": rows.column("places"),
                     "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(ids, pa.binary())})


class ChunkIds:
    """The ids of a chunk's texts, put together by position from the answers to its words."""

    def __init__(self, texts: pa.Table, answers: pa.Table):
        place = [np.cumsum(_unpacked_ints(x).astype(np.int64))
                 for x in answers.column("places").to_pylist()]
        sizes = [_unpacked_ints(x).astype(np.int64) for x in answers.column("sizes").to_pylist()]
        flat = [_unpacked_ints(x) for x in answers.column("ids").to_pylist()]
        total = 1 + max((int(p[-1]) for p in place), default=-1)
        self.count, self.start = np.full(total, -1, np.int64), np.zeros(total, np.int64)
        self.ids, base = np.concatenate([np.zeros(0, "<u4"), *flat]), 0
        for where, size, ids in zip(place, sizes, flat):
            self.count[where], self.start[where] = size, base + np.cumsum(size) - size
            base += len(ids)
        if (self.count < 0).any():
            raise RuntimeError("a chunk lacks ids of some of its words")
        owners = [part.flatten() for part in texts.column("ids").chunks]
        self.owners = pa.chunked_array(owners, texts.column("ids").type.value_type)
        self.texts = texts

    def places(self) -> Iterator[np.ndarray]:
        """The places of each text's words."""
        for counts, data in zip(self.texts.column("counts").to_pylist(),
                                self.texts.column("places").to_pylist()):
            ends = np.cumsum(_unpacked_ints(counts).astype(np.int64))
            yield from np.split(_unpacked_ints(data), ends[:-1])

    def of(self, at: np.ndarray) -> np.ndarray:
        """The ids of a text whose words have these places."""
        size = self.count[at]
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(n) + np.repeat(self.start[at] - ends + size, size)]

    def decoded(self, pieces: list[bytes]) -> list[bytes]:
        """For each word its ids' pieces, joined by a space."""
        named = [pieces[i] for i in self.ids.tolist()]
        return [b" ".join(named[a:a + n]) for a, n in zip(self.start.tolist(), self.count.tolist())]


def _by_position(texts: pa.Table, answers: pa.Table, pieces: list[bytes]) -> pa.Table:
    """A chunk's texts as ids, and decoded through the table of pieces."""
    chunk = ChunkIds(texts, answers)
    decoded, empty = chunk.decoded(pieces), bool((chunk.count == 0).any())
    values, plain = [], []
    for at in chunk.places():
        values.append(chunk.of(at))
        if empty:
            at = at[chunk.count[at] > 0]
        plain.append(b" ".join([decoded[i] for i in at.tolist()]))
    offsets = pa.array(np.cumsum([0, *map(len, values)]), pa.int32())
    return pa.table({
        "id": chunk.owners,
        "ids": pa.ListArray.from_arrays(offsets, pa.array(
            np.concatenate([np.zeros(0, "<u4"), *values]).astype(np.int32), pa.int32()),
            type=pa.list_(pa.field("element", pa.int32()))),
        "decoded": pa.array(plain, pa.binary()).cast(pa.string())})


def per_chunk(
    docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str,
    finish: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType,
) -> DataFrame:
    """``finish`` over each chunk's texts and the ids of its words, for use with ``ChunkIds``."""
    # Chunks lie in buckets, so their texts are written once and never shuffled.
    chunked = stored_by(_chunked(docs, id_col, text_col, 2 * width(docs)), "chunk", width(docs))
    texts = chunked.where("bucket is null").select("chunk", "ids", "counts", "places")
    answers = chunked.where("bucket is not null").select(
        "bucket", "chunk", "places", "words").groupBy("bucket").applyInArrow(
            lambda rows: _encode_bucket(rows, tokenizer_path),
            "chunk long, places binary, sizes binary, ids binary")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)


def encoded(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document its id, ``ids`` and ``decoded``, the text that the ids decode to."""
    schema = docs.select(F.col(id_col).alias("id")).schema.add(
        "ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return per_chunk(
        docs, tokenizer_path, id_col, text_col,
        lambda texts, answers: _by_position(texts, answers, piece_table(tokenizer_path)),
        schema).withColumnRenamed("id", id_col)
