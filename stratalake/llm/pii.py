"""Personal data: fixed rules, and spans that a BiLSTM-CRF over characters adds to them.

The rules' spans stay as they are. They also label the training windows: up to ``train_windows``
windows around digits and ``@`` are drawn by hash, half of them without a span and the others in equal
parts from all kinds. Each is trained on as it is and in a form that the rules do not know: addresses
with ``(at)`` or blanks, cards with dots, phone numbers without a country code. The tagger is trained
in numpy on the driver. It then reads every place where a span can be. Every span holds a digit, an
``@`` or an ``(at)``, so places further than ``REACH`` characters from one are not read; the rest of a
text is one region per cluster of them, however long. A region is cut into overlapping windows, their
scores are averaged with weights that favour a window's middle, and one best path is taken through
the whole region. A span that the tagger finds counts if it touches no rule's span and is plausible
for its kind: a card needs a valid check digit, a phone number 7 to 15 digits in groups, and a date is
neither.

Defined cases: a NULL text is empty; without any labelled span only the rules apply; repeated rows
and NULL ids keep their rows; an empty table gives an empty result; only the id and the text column
are read. Offsets are in code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import arrow_batches
from stratalake.llm.lstm_crf import Tagger, codes

KINDS = ("email", "ip", "card", "phone")
REACH, WINDOW, STRIDE = 24, 64, 32
#: Training windows at most, and optimiser steps.
TRAIN_WINDOWS, TRAIN_STEPS = 1_500, 400
#: Further forms of a training window, at most.
FORMS = 6

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the start of a run of digits; looking behind keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT, _DOT = r"(?:@|\(at\)|\[at\])", r"(?:\.|\(dot\)|\[dot\])"
_TRIGGER = re.compile(rf"[0-9]|{_AT}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        begin = at
        while domain and begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at:
            yield begin, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(int(part) <= 255 for part in text.split(".") if len(part) < 300) and all(
        len(part.lstrip("0")) <= 3 for part in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def has_trigger(text: str) -> bool:
    return any(char in text for char in ("@", "(at)", "[at]", *"0123456789"))


def rule_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the rules by kind and start, and the matches that failed their test."""
    spans: list[Span] = [(0, a, b) for a, b in _emails(text)]
    failed = []
    for kind, pattern, test in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        for match in pattern.finditer(text):
            if test(match[0]):
                spans.append((kind, *match.span()))
            elif len(_digits(match[0])) > 8:
                failed.append(match.span())
    return spans, failed


_FORM = (
    re.compile(rf"[A-Za-z0-9._%+-]+\x20?{_AT}\x20?[A-Za-z0-9-]+(?:\x20?{_DOT}\x20?[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[\x20./-]?[0-9])+"),
    re.compile(r"[+(]?[0-9][\x20().0-9/-]+[0-9]"),
)
_DATE = re.compile(
    r"(?:19|20)[0-9]{2}([-./ ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./ ])[0-9]{1,2}\2(?:19|20)[0-9]{2}")


def _is_phone_form(text: str) -> bool:
    groups = re.findall(r"[0-9]+", text)
    return (7 <= sum(map(len, groups)) <= 15 and len(groups) > 1 and not _DATE.fullmatch(text)
            and (text[0] in "+(0" or len(groups) > 2) and not _FORM[1].fullmatch(text))


_TESTS = (lambda s: True, lambda s: _is_ip(s.replace(" ", "")), _is_card, _is_phone_form)


def has_form(kind: int, text: str) -> bool:
    """Whether a span that the tagger found can be of its kind."""
    return bool(_FORM[kind].fullmatch(text)) and _TESTS[kind](text)


def regions(text: str) -> list[tuple[int, int]]:
    """Where a span can be: the surroundings of digits and ``@``, merged."""
    out: list[list[int]] = []
    for match in _TRIGGER.finditer(text):
        begin, end = max(0, match.start() - REACH), min(len(text), match.end() + REACH)
        if out and begin <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def _tags(begin: int, end: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(end - begin, np.int64)
    for kind, a, b in spans:
        if begin <= a and b <= end:
            tags[a - begin:b - begin] = 2 + 2 * kind
            tags[a - begin] = 1 + 2 * kind
    return tags


def _windows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Labelled windows: those that hold whole spans, or none, and no failed match."""
    texts, labels, kinds = [], [], []
    for text in batch.column("text").to_pylist():
        if not text or not has_trigger(text):
            continue
        spans, failed = rule_spans(text)
        for first, last in regions(text):
            for begin in range(first, max(first + 1, last - WINDOW + STRIDE), STRIDE):
                end = min(last, begin + WINDOW)
                held = [(kind, a, b) for kind, a, b in spans if a < end and b > begin]
                if all(b <= begin or a >= end for a, b in failed) and all(
                        begin <= a and b <= end for _, a, b in held):
                    texts.append(text[begin:end])
                    labels.append(bytes(_tags(begin, end, held).astype(np.uint8)))
                    kinds.append(held[0][0] if held else -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), pa.array(labels, pa.binary()), pa.array(kinds, pa.int32())],
        names=["window", "tags", "kind"])


def formed(kind: int, text: str, random: np.random.Generator) -> str:
    """A span with other digits, in a form of its kind that the rules may not know."""
    text = re.sub(r"[0-9]", lambda _: str(random.integers(0, 10)), text)
    if kind == 0:
        at, dot = (("@", "."), (" @ ", "."), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"),
                   (" [at] ", "."))[random.integers(0, 6)]
        local, _, domain = text.partition("@")
        return f"{local}{at}{domain.replace('.', dot)}"
    if kind == 1:
        return text.replace(".", (".", ".", " . ")[random.integers(0, 3)])
    if kind == 2:
        digits, mark = _digits(text), (" ", "-", ".", "/", "")[random.integers(0, 5)]
        return mark.join(digits[at:at + 4] for at in range(0, len(digits), 4))
    digits, style = _digits(text), int(random.integers(0, 5))
    if style == 0:
        return text
    if style == 1:
        return re.sub(r"[()\x20.-]+", ".", text)
    mark, local = (" ", "-", "/", ".")[random.integers(0, 4)], digits[2:]
    if style == 2:
        return f"0{local[:3]}{mark}{local[3:]}"
    if style == 3:
        return f"({local[:3]}) {local[3:6]}-{local[6:]}"
    return mark.join((local[:3], local[3:6], local[6:]))


def varied(text: str, tags: np.ndarray, random: np.random.Generator) -> tuple[str, np.ndarray]:
    """The text with its spans in other forms, and their tags."""
    parts, found, last = [], [], 0
    for kind, begin, end in _spans_of(tags):
        span = formed(kind, text[begin:end], random)
        parts += [text[last:begin], span]
        found += [np.zeros(begin - last, np.int64), _tags(0, len(span), [(kind, 0, len(span))])]
        last = end
    return "".join([*parts, text[last:]]), np.concatenate(
        [*found, np.zeros(len(text) - last, np.int64)])


def train(
    docs: DataFrame, text_col: str = "text", train_windows: int = TRAIN_WINDOWS,
    steps: int = TRAIN_STEPS, seed: int = 3,
) -> Tagger | None:
    """A tagger from at most ``train_windows`` windows; None without any labelled span."""
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(
        arrow_batches(_windows_of), "window string, tags binary, kind int")
    # Of each bucket the window with the smallest hash stays: the same ones every time, and all kinds
    # have their part however rare they are.
    share = F.when(F.col("kind") < 0, train_windows // 2).otherwise(
        train_windows // (2 * len(KINDS)))
    key = F.xxhash64("window")
    kept = found.groupBy("kind", F.pmod(key, F.greatest(F.lit(1), share)).alias("bucket")).agg(
        F.min(F.struct(key.alias("key"), "window", "tags")).alias("least"))
    rows = sorted(kept.select("least.window", "least.tags").collect())
    if not any(any(row["tags"]) for row in rows):
        return None
    random, windows, labels = np.random.default_rng(seed), [], []
    for row in rows:
        tags = np.frombuffer(row["tags"], np.uint8).astype(np.int64)
        # Where there are few windows with spans, each is there in more forms.
        for nth in range(1 + min(FORMS, 2 * train_windows // len(rows)) if tags.any() else 1):
            text, own = varied(row["window"], tags, random) if nth else (row["window"], tags)
            windows.append(codes(text)[:WINDOW])
            labels.append(own[:WINDOW])
    x, y = np.zeros((len(windows), WINDOW), np.int64), np.zeros((len(windows), WINDOW), np.int64)
    for place, (window, own) in enumerate(zip(windows, labels)):
        x[place, :len(window)], y[place, :len(own)] = window, own
    tagger = Tagger(len(KINDS))
    tagger.fit(x, y, steps=steps)
    return tagger


_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def tagged(tagger: Tagger, parts: list[str]) -> list[np.ndarray]:
    """One best tag sequence for each region, from the scores of its overlapping windows."""
    owner, offset, coded = [], [], [codes(part) for part in parts]
    for place, part in enumerate(parts):
        for at in range(0, max(1, len(part) - WINDOW + STRIDE), STRIDE):
            owner.append(place)
            offset.append(at)
    score = [np.zeros((len(part), tagger.tags), np.float32) for part in parts]
    weight = [np.zeros((len(part), 1), np.float32) for part in parts]
    for begin in range(0, len(owner), 512):
        x = np.zeros((min(512, len(owner) - begin), WINDOW), np.int64)
        for row in range(len(x)):
            own = coded[owner[begin + row]][offset[begin + row]:][:WINDOW]
            x[row, :len(own)] = own
        for row, window in enumerate(tagger.scores(x)):
            place, at = owner[begin + row], offset[begin + row]
            n = min(WINDOW, len(parts[place]) - at)
            score[place][at:at + n] += window[:n] * _WEIGHT[:n, None]
            weight[place][at:at + n] += _WEIGHT[:n, None]
    order = sorted(range(len(parts)), key=lambda place: len(parts[place]))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(parts)
    at = 0
    while at < len(order):
        # Regions of similar length share a batch; a very long one is alone.
        count = max(1, min(512, 65_536 // max(1, len(parts[order[min(at + 511, len(order) - 1)]]))))
        some = order[at:at + count]
        lengths = np.array([len(parts[place]) for place in some])
        full = np.zeros((len(some), max(1, int(lengths.max())), tagger.tags), np.float32)
        for row, place in enumerate(some):
            full[row, :lengths[row]] = score[place] / np.maximum(weight[place], 1e-9)
        for place, path in zip(some, tagger.decode(full, lengths)):
            out[place] = path
        at += count
    return out


def _spans_of(tags: np.ndarray) -> Iterator[Span]:
    for begin in np.flatnonzero(tags % 2 == 1).tolist():
        kind, end = (int(tags[begin]) - 1) // 2, begin + 1
        while end < len(tags) and tags[end] == tags[begin] + 1:
            end += 1
        yield kind, begin, end


def _scan(batch: pa.RecordBatch, tagger: Tagger | None) -> Iterator[pa.RecordBatch]:
    found, parts, places = [], [], []
    for row, text in enumerate(batch.column("text").to_pylist()):
        text = text or ""
        spans, _ = rule_spans(text) if has_trigger(text) else ([], [])
        found.append([(kind, a, b, False) for kind, a, b in spans])
        if tagger is not None and has_trigger(text):
            for begin, end in regions(text):
                parts.append(text[begin:end])
                places.append((row, begin))
    if parts:
        for (row, base), part, tags in zip(places, parts, tagged(tagger, parts)):
            for kind, begin, end in _spans_of(tags):
                a, b = base + begin, base + end
                if has_form(kind, part[begin:end]) and all(
                        b <= x or a >= y for _, x, y, _ in found[row]):
                    found[row].append((kind, a, b, True))
    spans = [[{"kind": KINDS[kind], "start": a, "end": b, "added": added}
              for kind, a, b, added in sorted(own)] for own in found]
    yield pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(spans, _SPANS)], names=["id", "spans"])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("added", pa.bool_())]))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    train_windows: int = TRAIN_WINDOWS, steps: int = TRAIN_STEPS,
) -> DataFrame:
    """Per document its id and ``spans`` by kind and start; ``added`` marks the tagger's."""
    tagger = train(docs, text_col, train_windows, steps)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = "array<struct<kind:string,start:bigint,end:bigint,added:boolean>>"
    schema = source.select("id", F.lit(None).cast(kind).alias("spans")).schema
    return source.mapInArrow(
        arrow_batches(lambda batch: _scan(batch, tagger)), schema).withColumnRenamed("id", id_col)
