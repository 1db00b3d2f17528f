"""Quality rules: within-text measures and lines that too many documents of one host share.

Lines are compared in lower case with white space collapsed. A line that more distinct documents of a
host hold than its limit is removed from that host's documents, and a document that keeps less than
``least_left`` of its words is rejected. The limit is ``min_documents``, or the square root of the
host's documents where that is more: it rises with the host, and far slower than it.

Each distinct text of a host is one narrow row of line hashes with the number of its documents, so
copies are split once and a line that all documents share is summed before any shuffle.
``distinct_texts`` counts each text once, however many documents hold it, and ``near`` also counts a
group of near copies once: copying alone then makes no line frequent.

Defined cases: a NULL text has no words and fails the base rules, as an empty one does; a NULL host
is the host ``''``; repeated rows each count and get their row; documents without any removable line
keep all; an empty table gives an empty result. Only the named columns are read, so extra columns
don't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import (
    WORD, arrow_batches, covered, stored, utf8, window_hashes, window_starts, word_hashes)

SYMBOLS = "#*$%&|<>"
BLANKS = "\t\n\x0b\x0c\r "
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
MIN_DOCUMENTS, LEAST_LEFT = 20, 0.3
#: Text that is hashed together: hashing takes some fifty times as much memory for a moment.
BATCH_BYTES = 1 << 19

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _measure(batch: pa.RecordBatch, carry: list[str]) -> Iterator[pa.RecordBatch]:
    column = batch.column("text")
    hashes, counts = word_hashes(utf8(column))
    texts = [text or "" for text in column.to_pylist()]
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = window_starts(counts, REPEAT_WINDOW)
    # The owner is part of the key, so only windows of one text can meet.
    key = window_hashes(hashes, begin, REPEAT_WINDOW) + owner[begin].astype(np.uint64) * np.uint64(
        0x9FB21C651E98DF25)
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    mask = covered(begin[times[inverse] > 1], REPEAT_WINDOW, len(hashes))
    values = (
        counts,
        [len(t) - sum(map(t.count, BLANKS)) for t in texts],
        [sum(map(t.count, SYMBOLS)) for t in texts],
        [_dup_lines(t) for t in texts],
        np.bincount(owner[mask], minlength=len(counts)),
    )
    yield pa.RecordBatch.from_arrays(
        [*(batch.column(name) for name in carry), *(pa.array(v, pa.int64()) for v in values)],
        names=[*carry, *_MEASURES])


def _source(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns if name != text_col)).alias("row"),
        text.alias("text"), F.coalesce(host_col, F.lit("")).alias("host"),
        # Two hashes with different seeds stand for the text.
        F.xxhash64(text).alias("content"), F.xxhash64(F.lit(7), text).alias("content2"))


def _normal(line: F.Column) -> F.Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


_TEXT = ("host", "content", "content2")


def _texts(source: DataFrame) -> DataFrame:
    """Each distinct text of a host: the number of its documents, and hash and words of its lines."""
    lines = F.transform(F.split("text", "\n", -1), lambda line: F.struct(
        F.xxhash64(_normal(line)).alias("hash"),
        F.regexp_count(line, F.lit(WORD)).cast("long").alias("words")))
    held = F.filter(lines, lambda line: line["words"] > 0)
    return source.where("text is not null").select(*_TEXT, held.alias("lines")).groupBy(*_TEXT).agg(
        F.count("*").alias("documents"), F.first("lines").alias("lines"))


def _limits(source: DataFrame, min_documents: int) -> DataFrame:
    """(host, limit)."""
    return source.groupBy("host").agg(F.greatest(
        F.lit(float(min_documents)), F.sqrt(F.count("*").cast("double"))).alias("limit"))


def frequent_lines(
    texts: DataFrame, limits: DataFrame, min_documents: int = MIN_DOCUMENTS,
    distinct_texts: bool = False, near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(host, hash) of the lines above their host's limit.

    ``near`` takes (content, content2) and gives each of them the column ``one``, which near copies
    share. It sees only texts with a line above the limit: no other text can change the result.
    """
    each = texts.select(*_TEXT, "documents", F.explode(F.array_distinct("lines.hash")).alias("hash"))
    times = F.lit(1) if distinct_texts or near else F.col("documents")
    counted = each.groupBy("host", "hash").agg(F.sum(times).alias("n"))
    found = counted.where(F.col("n") > min_documents).join(limits, "host").where("n > limit")
    if near is None:
        return found.select("host", "hash")
    found = stored(found.select("host", "hash", "limit"))
    held = stored(each.join(found, ["host", "hash"]).select(*_TEXT, "hash", "limit"))
    member = near(held.select("content", "content2").distinct())
    return held.join(member, ["content", "content2"]).select(
        "host", "hash", "limit", "one").distinct().groupBy("host", "hash", "limit").agg(
            F.count("*").alias("n")).where("n > limit").select("host", "hash")


def _losses(
    source: DataFrame, min_documents: int, distinct_texts: bool,
    near: Callable[[DataFrame], DataFrame] | None,
) -> DataFrame:
    """Per distinct text of a host with frequent lines: their hashes and their words."""
    texts = stored(_texts(source))
    # Stored, so that the join knows how few these lines are.
    frequent = stored(frequent_lines(
        texts, _limits(source, min_documents), min_documents, distinct_texts, near))
    lines = texts.select(*_TEXT, F.explode("lines").alias("l")).select(*_TEXT, "l.hash", "l.words")
    return lines.join(frequent, ["host", "hash"]).groupBy(*_TEXT).agg(
        F.collect_set("hash").alias("bad"), F.sum("words").alias("n_removed_words"))


def _judged(
    source: DataFrame, with_text: bool, min_documents: int, least_left: float,
    distinct_texts: bool = False, near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    carry = [name for name in source.columns if with_text or name != "text"]
    schema = source.select(*carry).schema
    for name in _MEASURES:
        schema = schema.add(name, "long")
    measured = source.mapInArrow(
        arrow_batches(lambda batch: _measure(batch, carry), BATCH_BYTES), schema)
    losses = _losses(source, min_documents, distinct_texts, near)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    removed = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    depleted = F.col("n_words") - removed < F.col("n_words") * least_left
    # Either side grows with the corpus: neither is built in memory, at any size.
    return measured.join(losses.hint("merge"), list(_TEXT), "left").select(
        "row", *(["text"] if with_text else []), "bad", *_MEASURES,
        failed.alias("base_failed"), removed.alias("n_removed_words"),
        (~failed & ~depleted).alias("kept"))


def verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    least_left: float = LEAST_LEFT,
    distinct_texts: bool = False,
) -> DataFrame:
    """One row per document: measures, ``base_failed``, words in frequent lines, ``kept``."""
    source = _source(docs.select(id_col, text_col, host_col), text_col, host_col)
    return _judged(source, False, min_documents, least_left, distinct_texts).select(
        F.col("row")[id_col].alias(id_col), *_MEASURES, "base_failed", "n_removed_words", "kept")


def cleaned(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    least_left: float = LEAST_LEFT,
    distinct_texts: bool = False,
    near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The kept documents with all their columns; frequent lines are taken out of the text.

    ``near`` takes texts (content, content2, text) and returns (content, content2, one), where near
    copies share ``one``. A group of them then counts as one document, so that it is not rejected
    for the lines its members share.
    """
    source = _source(docs, text_col, host_col)

    def member(asked: DataFrame) -> DataFrame:
        texts = source.select("content", "content2", "text").join(
            asked, ["content", "content2"], "left_semi")
        return near(stored(texts.dropDuplicates(["content", "content2"])))

    judged = _judged(source, True, min_documents, least_left, distinct_texts,
                     None if near is None else member)
    left = F.filter(F.split("text", "\n", -1), lambda line: ~F.array_contains(
        "bad", F.xxhash64(_normal(line))))
    text = F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return judged.where("kept").select(*(
        text.alias(name) if name == text_col else F.col("row")[name].alias(name)
        for name in docs.columns))
