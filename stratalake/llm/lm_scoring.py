"""Language-model scores: the probability of a text under all its spellings in subword pieces.

The pieces of an existing vocabulary form a unigram model: a text is a sequence of pieces, words begin
with a mark, and one end closes the text. The existing scores weight all spellings at first. On the
training texts the expected use of each piece over all spellings then gives its probability
(``EM_ROUNDS`` rounds of expectation and maximisation, in which the existing scores stay as a prior
of ``PRIOR`` uses). The vocabulary itself is never changed. A text's score is the logarithm of the
sum over its spellings, by forward recursion in log space: as no piece crosses a word, it is the sum
over its words, and each distinct word of the corpus has one lattice (see ``lattice``).

Texts are split in chunks. A chunk lists its distinct words with their number in its training texts,
and keeps its texts as places in that list. Counts of words are summed over the corpus, each distinct
word is scored once, and counts and scores are joined back to the lists. So a word that all texts
hold is one row for each chunk, and the table of words grows with the corpus.

Defined cases: a NULL or blank text has no word and is its end alone; a NULL id is the empty text
where the fold is chosen; repeated rows each count and get a row; without any training text the
existing scores alone are the model and each base probability is 1; an empty table gives an empty
result; only the id and the text column are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import stored, utf8, width
from stratalake.llm.lattice import Lattices, Trie, vocabulary

#: Texts whose fold is this one of so many are held out.
FOLDS, HELD_OUT = 5, 1
EM_ROUNDS, PRIOR = 4, 10_000.0
#: Texts of about so many bytes share one list of distinct words.
CHUNK_BYTES = 8 << 20
#: Words whose lattices are in memory together hold about so many bytes.
LATTICE_BYTES = 256 << 10


class Model(NamedTuple):
    """Pieces, their log probabilities, that of the end, and what the base score needs."""

    pieces: list[bytes]
    scores: np.ndarray
    end: float
    tokens: int
    distinct: int
    texts: int


def fold(id_col: str, folds: int = FOLDS) -> F.Column:
    """CRC-32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")),
                  F.lit(folds))


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values, "<u4").tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u4")


_LISTED = ("place", "word", "times")


def _chunk(parts: list[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row of texts as places of their words, and a row for each distinct word."""
    known: dict[bytes, int] = {}
    places, counts, name = [], [], hashlib.blake2b(digest_size=8)
    for part in parts:
        for text in utf8(part.column("text")):
            name.update(len(text).to_bytes(8, "little") + text)
            words = text.lower().split()  # of bytes: A-Z and ASCII blanks only
            for word in words:
                if word not in known:
                    known[word] = len(known)
            places.append(np.array([known[word] for word in words], "<u4"))
            counts.append(len(words))
    own = pa.concat_arrays([part.column("id") for part in parts])
    held = np.concatenate([part.column("held").to_numpy(zero_copy_only=False) for part in parts])
    chunk, flat = int.from_bytes(name.digest(), "little", signed=True), np.concatenate(places)
    times = np.bincount(flat[np.repeat(~held, counts)], minlength=len(known))
    n = len(known)
    yield pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()),
         pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own, type=kind),
         pa.array([np.packbits(held).tobytes()], pa.binary()),
         pa.array([int((~held).sum())], pa.int64()),
         pa.array([_packed(np.array(counts))], pa.binary()), pa.array([_packed(flat)], pa.binary()),
         pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())],
        names=["chunk", "ids", "held", "trained", "counts", "places", *_LISTED])
    words = list(known)
    for at in range(0, n, 10_000):
        some = words[at:at + 10_000]
        m = len(some)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, chunk), pa.int64()), pa.nulls(m, kind), pa.nulls(m, pa.binary()),
             pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()),
             pa.array(np.arange(at, at + m), pa.int32()), pa.array(some, pa.binary()),
             pa.array(times[at:at + m], pa.int64())],
            names=["chunk", "ids", "held", "trained", "counts", "places", *_LISTED])


def _chunked(docs: DataFrame, id_col: str, text_col: str, folds: int, held_out: int) -> DataFrame:
    """Rows of texts (``word`` is NULL) and of distinct words, under a hash of the chunk's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, kind = [], 0, None
        for batch in batches:
            kind = pa.list_(pa.field("element", batch.column("id").type))
            for at in range(0, batch.num_rows, 64):
                parts.append(batch.slice(at, 64))
                size += parts[-1].nbytes
                if size > CHUNK_BYTES:
                    yield from _chunk(parts, kind)
                    parts, size = [], 0
        if parts:
            yield from _chunk(parts, kind)

    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        (fold(id_col, folds) == held_out).alias("held"))
    schema = T.StructType().add("chunk", "long").add(
        "ids", T.ArrayType(source.schema["id"].dataType)).add("held", "binary").add(
            "trained", "long").add("counts", "binary").add("places", "binary").add(
                "place", "integer").add("word", "binary").add("times", "long")
    return source.mapInArrow(run, schema)


def _some(words: list[bytes], trie: Trie) -> Iterator[tuple[slice, Lattices]]:
    """Lattices of the words, as many at a time as the memory is meant for."""
    begin, size = 0, 0
    for at, word in enumerate(words):
        size += len(word) + 1
        if size > LATTICE_BYTES or at + 1 == len(words):
            yield slice(begin, at + 1), Lattices(words[begin:at + 1], trie)
            begin, size = at + 1, 0


def _uses(words: DataFrame, pieces: list[bytes], scores: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in all training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, uses = Trie(pieces), np.zeros(len(pieces))
        for batch in batches:
            times = batch.column("times").to_numpy(zero_copy_only=False)
            for part, lattices in _some(utf8(batch.column("word")), trie):
                uses += lattices.expected(scores, times[part].astype(np.float64))
        used = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(uses[used])], names=["piece", "uses"])

    found = words.where("times > 0").select("word", "times").mapInArrow(
        run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    uses = np.zeros(len(pieces))
    for row in found.collect():  # at most one row for each piece of the vocabulary
        uses[row["piece"]] = row["uses"]
    return uses


def learned(words: DataFrame, texts: int, path: str, rounds: int = EM_ROUNDS) -> Model:
    """The model of the training words (word, times) of so many texts."""
    pieces, given = vocabulary(path)
    total = words.where("times > 0").agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    # The end is as likely as the likeliest piece at first.
    start = np.append(given, given.max())
    start -= np.log(np.exp(start).sum())
    scores = start
    for _ in range(rounds if texts else 0):
        uses = np.append(_uses(words, pieces, scores[:-1]), texts) + PRIOR * np.exp(start)
        scores = np.log(uses) - np.log(uses.sum())
    return Model(pieces, scores[:-1], float(scores[-1]), int(total["tokens"]) + texts,
                 int(total["distinct"]) + (texts > 0), texts)


def _scored(words: DataFrame, model: Model) -> DataFrame:
    """(word, times, score) of each distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(model.pieces)
        for batch in batches:
            for part, lattices in _some(utf8(batch.column("word")), trie):
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [own.column("word"), own.column("times"),
                     pa.array(lattices.likelihoods(model.scores) / np.log(10))],
                    names=["word", "times", "score"])

    return words.mapInArrow(run, "word binary, times long, score double")


def _base(times: np.ndarray, model: Model) -> np.ndarray:
    """Base score of tokens that occur so often in training."""
    return np.log10((times + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))


def _finished(texts: pa.Table, answers: pa.Table, model: Model) -> pa.Table:
    """The chunk's texts with the sums over their words and the end."""
    place = answers.column("place").to_numpy()
    size = 1 + int(place.max()) if len(place) else 0
    times, score = np.full(size, -1, np.int64), np.zeros(size)
    times[place] = answers.column("times").to_numpy()
    score[place] = answers.column("score").to_numpy()
    if (times < 0).any():
        raise RuntimeError("a chunk lacks the scores of some of its words")
    base, known = _base(times, model), (times > 0).astype(np.float64)
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    for held, counts, places in zip(*(texts.column(name).to_pylist()
                                      for name in ("held", "counts", "places"))):
        own, flat = _unpacked(counts).astype(np.int64), _unpacked(places)
        owner = np.repeat(np.arange(len(own)), own)
        columns[0].append(np.unpackbits(np.frombuffer(held, np.uint8), count=len(own)) > 0)
        columns[1].append(own + 1)
        columns[2].append(np.bincount(owner, known[flat], len(own)).astype(np.int64) + (model.texts > 0))
        columns[3].append(np.bincount(owner, base[flat], len(own)) + _base(
            np.array([model.texts]), model))
        columns[4].append(np.bincount(owner, score[flat], len(own)) + model.end / np.log(10))
    held, tokens, known, base, score = (np.concatenate(part) for part in columns)
    owners = pa.chunked_array([part.flatten() for part in texts.column("ids").chunks],
                              texts.column("ids").type.value_type)
    return pa.table({
        "id": owners, "held_out": pa.array(held), "n_tokens": pa.array(tokens, pa.int64()),
        "n_known": pa.array(known, pa.int64()),
        "train_tokens": pa.array(np.full(len(held), model.tokens), pa.int64()),
        "base_score": pa.array(base), "score": pa.array(score)})


def scored(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
    folds: int = FOLDS, held_out: int = HELD_OUT, rounds: int = EM_ROUNDS,
) -> DataFrame:
    """Per text: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score``, the last two as decimal logarithms."""
    chunks = stored(_chunked(docs, id_col, text_col, folds, held_out))
    texts = chunks.where("word is null").select(F.col("chunk").alias("chunk"), "ids", "held", "counts", "places")
    lists = chunks.where("word is not null").select("chunk", *_LISTED)
    # Lattices are the work of this table, so its tasks are not merged.
    words = stored(lists.repartition(width(docs), "word").groupBy("word").agg(
        F.sum("times").alias("times")))
    trained = chunks.agg(F.coalesce(F.sum("trained"), F.lit(0))).first()[0]
    model = learned(words, int(trained), vocabulary_path, rounds)
    answers = lists.select("chunk", "place", "word").join(_scored(words, model), "word").select(
        "chunk", "place", "times", "score")
    schema = docs.select(F.col(id_col).alias("id")).schema.add("held_out", "boolean")
    for name in ("n_tokens", "n_known", "train_tokens"):
        schema = schema.add(name, "long")
    schema = schema.add("base_score", "double").add("score", "double")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda own, found: _finished(own, found, model), schema).withColumnRenamed("id", id_col)
