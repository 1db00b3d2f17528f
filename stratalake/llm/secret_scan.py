"""Secrets in texts: a trigram inverted index finds candidates, the regular expressions verify them.

Each rule's pattern gives a Boolean query over the trigrams that every match contains. Documents
are indexed under the trigrams that some rule asks for, postings are intersected per document, and
only candidates of a rule are searched with its pattern. A rule without mandatory trigrams is
searched in every document. Verification runs on whole texts, so the index never changes a result.

Matches are leftmost and non-overlapping per rule; one that fails the rule's test is dropped without
another try. Spans are in code points, end exclusive. Defined cases: a NULL text is empty; NULL ids
and repeated rows are searched like any row; an empty table gives an empty result; spans of
different rules may overlap, and redaction replaces their union.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_batches, utf8
from stratalake.llm.trigrams import holds, trigram_query, trigrams


@dataclass(frozen=True)
class Rule:
    """``least`` is the shortest length of ``group`` that counts; ``any_case`` is for A-Z only."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    def finder(self) -> Callable[[str], Iterator[tuple[int, int]]]:
        found = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))
        group, least = self.group, self.least

        def spans(text: str) -> Iterator[tuple[int, int]]:
            for match in found.finditer(text):
                if match.end(group) - match.start(group) >= least:
                    yield match.span()

        return spans


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*"""
         r"""["']?([A-Za-z0-9+/_.=-]+)""", least=12, group=2, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),  # whole runs, as [0-9a-f]+ of 16 or more
)
# Published token formats of well-known services.
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@lru_cache(maxsize=2)
def _lookup(wanted: tuple[str, ...]) -> np.ndarray:
    """For every three bytes the place of their trigram in ``wanted``, from 1; else 0."""
    table = np.zeros(1 << 24, np.uint16)
    for place, (a, b, c) in enumerate((name.encode() for name in wanted), start=1):
        table[a | b << 8 | c << 16] = place
    return table


def _index(batch: pa.RecordBatch, wanted: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    texts = utf8(batch.column("text"))
    ends = np.cumsum([len(text) + 1 for text in texts])
    # No UTF-8 text holds the separating byte, so no trigram spans two texts.
    data = _LOWER[np.frombuffer(b"\xff".join([*texts, b"\xff"]), np.uint8)].astype(np.uint32)
    place = _lookup(wanted)[data[:-2] | data[1:-1] << 8 | data[2:] << 16]
    at = np.flatnonzero(place)
    key = np.unique(np.searchsorted(ends, at, side="right") << 16 | place[at])
    yield pa.RecordBatch.from_arrays(
        [batch.column("id").take(pa.array(key >> 16)),
         pa.array(wanted).take(pa.array((key & 0xFFFF) - 1))], names=["id", "trigram"])


def _postings(docs: DataFrame, id_col: str, text_col: str, wanted: tuple[str, ...]) -> DataFrame:
    """The inverted index: one row per document and wanted trigram that it contains."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(arrow_batches(lambda batch: _index(batch, wanted)),
                             source.select("id").schema.add("trigram", "string"))


def candidates(
    docs: DataFrame, rules: tuple[Rule, ...], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, rules): per document the indexed rules whose trigram query its postings satisfy."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    queries = {kind: query for kind, query in queries.items() if query is not None}
    wanted = tuple(sorted(set().union(*map(trigrams, queries.values()))))
    if not wanted:
        return docs.select(F.col(id_col).alias("id"), F.array().cast("array<string>").alias(
            "rules")).limit(0)
    merged = _postings(docs, id_col, text_col, wanted).groupBy("id").agg(
        F.collect_set("trigram").alias("have"))
    hits = F.array_compact(F.array(*(
        F.when(holds(query, lambda t: F.array_contains("have", t)), F.lit(kind))
        for kind, query in queries.items())))
    return merged.select("id", hits.alias("rules")).where(F.size("rules") > 0)


def _redacted(text: str, spans: list[tuple[int, str, int]], mask: str) -> str:
    out, last = [], 0
    for begin, _, end in spans:
        if begin >= last:
            out += [text[last:begin], mask]
        last = max(last, end)
    return "".join([*out, text[last:]])


def _verify(
    rules: tuple[Rule, ...], mask: str | None
) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    indexed = {rule.kind for rule in rules if trigram_query(rule.pattern) is not None}
    finders = [(rule.kind, rule.kind in indexed, rule.finder()) for rule in rules]
    rank = {rule.kind: place for place, rule in enumerate(rules)}

    def build(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        found, masked = [], []
        for text, hits in zip(texts, batch.column("rules").to_pylist()):
            spans = [(begin, kind, end) for kind, by_index, find in finders
                     if not by_index or (hits and kind in hits) for begin, end in find(text)]
            spans.sort(key=lambda span: (span[0], rank[span[1]]))
            found.append([{"kind": kind, "start": begin, "end": end} for begin, kind, end in spans])
            if mask is not None:
                masked.append(_redacted(text, spans, mask) if spans else text)
        columns = {"row": batch.column("row"), "secrets": pa.array(found, SPANS)}
        if mask is not None:
            columns["text"] = pa.array(masked, pa.string())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return build


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint>>"


def _verified(docs, rules, id_col, text_col, mask) -> DataFrame:
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns if name != text_col))
    rows = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    hits = candidates(docs, rules, id_col, text_col).hint("shuffle_hash")
    joined = rows.join(hits, rows["row"][id_col].eqNullSafe(hits["id"]), "left").select(
        "row", "text", "rules")
    schema = rows.select("row", F.lit(None).cast(SPANS_DDL).alias("secrets")).schema
    if mask is not None:
        schema = schema.add("text", "string")
    return joined.mapInArrow(arrow_batches(_verify(rules, mask)), schema)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id and ``secrets``, spans by start and then by rule."""
    found = _verified(docs.select(id_col, text_col), rules, id_col, text_col, None)
    return found.select(F.col("row")[id_col].alias(id_col), "secrets")


def redacted(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "<secret>",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """All documents with all their columns; secrets in the text are replaced by ``mask``."""
    found = _verified(docs, rules, id_col, text_col, mask)
    return found.select(*(
        F.col("text").alias(name) if name == text_col else F.col("row")[name].alias(name)
        for name in docs.columns))
