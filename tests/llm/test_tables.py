"""The registered queries against plain Python over the smallest test tables."""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from stratalake.llm.queries import QUERIES, public_tokenizers

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF_DIR}/documents.parquet").to_pydict()
    return {i: t or "" for i, t in zip(table["doc_id"], table["text"])}


def rows_of(spark, name: str, key: str = "doc_id") -> dict:
    return {row[key]: row for row in QUERIES[name](spark, SF_DIR).collect()}


def least_roots(ids: list, linked) -> dict:
    """Smallest id of each component, by repeated relabelling."""
    label, changed = {i: i for i in ids}, True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


def test_op1(spark, texts):
    words = {i: WORD.findall(t) for i, t in texts.items()}
    seen = Counter(tuple(w[k:k + 35]) for w in words.values() for k in range(len(w) - 34))
    found = rows_of(spark, "op1_substring_dedup")
    assert len(found) == len(texts)
    for i, w in words.items():
        gone = {p for k in range(len(w) - 34) if seen[tuple(w[k:k + 35])] > 1
                for p in range(k, k + 35)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        row = found[i]
        assert (row.n_words, row.n_removed, row.kept_sha256) == (len(w), len(gone), sha(kept))


def test_op2(spark, texts):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    prints = {}
    for i, text in texts.items():
        w = WORD.findall(text.translate(lower))
        parts = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
        prints[i] = sum(1 << b for b in range(64)
                        if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
              if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = least_roots(ids, linked)
    found = rows_of(spark, "op2_simhash_dedup")
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {
        i: (f"{prints[i]:016x}", roots[i]) for i in ids}


def test_op3(spark, texts):
    found = rows_of(spark, "op3_line_quality")
    for i, text in texts.items():
        w = WORD.findall(text)
        seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        twice = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1
                 for p in range(k, k + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        row, failed = found[i], len(w) < 20 or 100 * len(twice) > 30 * len(w)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
                row.base_failed) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(twice), failed)
        assert not (failed and row.kept)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_op4(spark, texts, tokenizer):
    want = {}
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[i, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op4_best_fit_packing"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.05 * -(-sum(v[1] for v in want.values()) // 2048) + 1


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     lambda s, d: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s, d: 13 <= len(d) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15),
)


def personal(text: str) -> list[str]:
    return [f"{kind}:{m.start()}:{m.end()}" for kind, pattern, test in PERSONAL
            for m in re.finditer(pattern, text) if test(m[0], re.sub("[^0-9]", "", m[0]))]


def test_op5(spark, texts):
    found = rows_of(spark, "op5_pii")
    assert len(found) == len(texts)
    for i, text in texts.items():
        spans = personal(text)
        assert found[i].base_sha256 == sha(",".join(spans))
        assert set(spans) <= set(found[i].spans.split(",")) | {""}
        assert found[i].n_email == sum(s.startswith("email") for s in spans)


def test_op7(spark, texts):
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in (
        "password", "passwd", "secret", "token", "api_?key"))
    rules = (
        (1, "access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        (0, "assign", rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 12),
        (2, "hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16))
    found = rows_of(spark, "op7_secret_scan")
    assert len(found) == len(texts)
    for i, text in texts.items():
        spans = sorted((m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
                       for rank, kind, pattern, test in rules
                       for m in re.finditer(pattern, text) if test(m))
        assert found[i].base_sha256 == sha(",".join(s for _, _, s in spans))


def test_op8(spark, texts, tokenizer):
    found = rows_of(spark, "op8_bpe")
    assert len(found) == len(texts)
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))),
            sha(tokenizer.decode(ids, skip_special_tokens=False)))


def test_op9(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pydict()
    vectors = np.array(table["embedding"], float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    a, b = np.nonzero(vectors @ vectors.T >= 0.95)
    ids = table["vec_id"]
    linked = [(ids[x], ids[y]) for x, y in zip(a.tolist(), b.tolist()) if x != y]
    count, roots = Counter(x for x, _ in linked), least_roots(ids, linked)
    found = rows_of(spark, "op9_embedding_dedup", "vec_id")
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in found.items()} == {
        i: (count[i], roots[i], roots[i] == i) for i in ids}


def test_op10(spark):
    table = pq.read_table(f"{SF_DIR}/pages.parquet").to_pydict()
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block",
             "com/fr/": "allow", "com/de/": "block"}
    found = rows_of(spark, "op10_url_filter", "page_id")
    assert len(found) == len(table["url"])
    for i, url in zip(table["page_id"], table["url"]):
        after = (url or "").partition("://")[2]
        host, path = re.match(r"([^/?#]*)([^?#]*)", after).groups()
        host = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        fitting = [r for r in rules if f".{host}".endswith("." + r.partition("/")[0])
                   and path.startswith("/" + r.partition("/")[2])]
        best = max(fitting, key=len, default=None)
        assert (found[i].host, found[i].path, found[i]["rule"]) == (host, path, best)
        assert found[i].verdict in ("allow", "block")
        assert best is None or found[i].verdict == rules[best]


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, former = docs.columns, set(texts)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR))
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "pack":
            assert docs.columns == columns and len(ids) == len(set(ids))
        assert set(ids) <= former
        if name == "quality_rules":
            kept = rows_of(spark, "op3_line_quality")
            assert set(ids) == {i for i, r in kept.items() if r.kept}
        former = set(ids)
    assert sorted(map(tuple, docs.drop("sequence_id", "offset").collect())) == sorted(map(
        tuple, corpus_pipeline.run(spark, SF_DIR).drop("sequence_id", "offset").collect()))
