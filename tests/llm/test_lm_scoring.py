"""Language-model scores against sums over all spellings, and on odd texts."""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalake.llm import lm_scoring
from stratalake.llm.lattice import Lattices, Trie, vocabulary
from stratalake.llm.queries import QUERIES, public_tokenizers

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def pieces():
    return vocabulary(PATH)


def all_spellings(word: bytes, probability: dict[bytes, float]) -> tuple[float, Counter]:
    """The sum over the spellings of a word by plain recursion, and the expected uses of pieces."""
    text = b" " + word

    @lru_cache(None)
    def before(i: int) -> float:
        return 1.0 if i == 0 else sum(
            before(j) * probability[text[j:i]] for j in range(i) if text[j:i] in probability)

    @lru_cache(None)
    def after(i: int) -> float:
        return 1.0 if i == len(text) else sum(
            probability[text[i:j]] * after(j) for j in range(i + 1, len(text) + 1)
            if text[i:j] in probability)

    total, uses = before(len(text)), Counter()
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in probability:
                uses[text[i:j]] += before(i) * probability[text[i:j]] * after(j) / total
    return total, uses


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").translate(UPPER).encode())


def test_vocabulary_is_a_distribution(pieces):
    assert len(pieces.pieces) == len(set(pieces.pieces))
    assert np.exp(pieces.scores).sum() == pytest.approx(1)
    assert {bytes([b]) for b in range(256)} <= set(pieces.pieces)
    assert all(b" " not in piece[1:] and (len(piece) == 1 or piece == piece.lower())
               for piece in pieces.pieces)


def test_lattices(pieces):
    words = [b"the", b"unbelievable", "naïveté".encode(), b"\x00\xff", b"", b"aaaaaaa", b"the"]
    probability = dict(zip(pieces.pieces, np.exp(pieces.scores).tolist()))
    lattices = Lattices(words, Trie(pieces.pieces))
    want = [all_spellings(word, probability) for word in words]
    assert lattices.likelihoods(pieces.scores) == pytest.approx([np.log(p) for p, _ in want])
    times = np.array([3.0, 1, 2, 1, 1, 0, 4])
    uses = Counter()
    for (_, own), n in zip(want, times):
        for piece, share in own.items():
            uses[piece] += share * n
    found = lattices.expected(pieces.scores, times)
    assert found == pytest.approx([uses[piece] for piece in pieces.pieces], abs=1e-9)


def test_long_words_do_not_underflow(pieces):
    found = Lattices([b"x" * 20_000, b"x" * 20_001], Trie(pieces.pieces)).likelihoods(pieces.scores)
    assert np.isfinite(found).all() and -10 < found[1] - found[0] < 0


def test_whole_table(spark, pieces):
    """Everything once more in plain Python, the model by the same rounds over all spellings."""
    table = pq.read_table(f"{SF_DIR}/documents.parquet").to_pydict()
    texts = {i: words_of(t) for i, t in zip(table["doc_id"], table["text"])}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    trained = Counter(word for i, words in texts.items() if not held[i] for word in words)
    n_texts = sum(not h for h in held.values())
    tokens, distinct = sum(trained.values()) + n_texts, len(trained) + 1
    trie, words = Trie(pieces.pieces), sorted(set().union(*texts.values()))
    start = np.append(pieces.scores, pieces.scores.max())
    start -= np.log(np.exp(start).sum())
    scores = start
    lattices, times = Lattices(words, trie), np.array([float(trained[w]) for w in words])
    for _ in range(lm_scoring.EM_ROUNDS):
        uses = np.append(lattices.expected(scores[:-1], times), n_texts) + (
            lm_scoring.PRIOR * np.exp(start))
        scores = np.log(uses / uses.sum())
    assert np.exp(scores).sum() == pytest.approx(1)
    value = dict(zip(words, lattices.likelihoods(scores[:-1])))
    rows = QUERIES["op12_lm_scoring"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        own = texts[row.doc_id]
        counts = [*(trained[w] for w in own), n_texts]
        base = sum(np.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1))) for c in counts)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (
            held[row.doc_id], len(own) + 1, sum(c > 0 for c in counts), tokens)
        assert row.base_score == pytest.approx(base)
        assert row.score == pytest.approx((sum(value[w] for w in own) + scores[-1]) / np.log(10))


def test_training_helps_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by_rounds = [lm_scoring.scored(docs, PATH, rounds=rounds).where("held_out").agg(
        F.sum("score") / F.sum("n_tokens")).first()[0] for rounds in (0, 1, 4)]
    assert by_rounds[0] + 1.5 < by_rounds[1] < by_rounds[2]


def test_odd_texts(spark):
    long = " ".join(f"word{k % 997}x{k}" for k in range(30_000))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one TWO"), (5, long), (4, "one TWO"),
             (None, "one two"), (7, "x" * 5000), (8, "naïve Σ ÉTÉ 😀 \x00 ▁a")]
    frame = spark.createDataFrame(texts, SCHEMA).withColumns(
        {name: F.lit("clash") for name in ("id", "word", "chunk", "times", "place", "held")})
    rows = lm_scoring.scored(frame, PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted(
        (str(i), len(words_of(t)) + 1) for i, t in texts)
    assert all(np.isfinite([r.score, r.base_score]).all() and r.score < 0 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
               for r in rows)
    blank = [r.score for r in rows if r.doc_id in (1, 2, 3)]
    assert blank == [blank[0]] * 3


def test_no_rows_and_no_training_texts(spark):
    frame = spark.createDataFrame([(1, "a b")], SCHEMA)
    assert lm_scoring.scored(frame.limit(0), PATH).count() == 0
    rows = lm_scoring.scored(frame, PATH, folds=1, held_out=0).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(True, 0, 0, 0.0)]
    assert rows[0].score < 0
