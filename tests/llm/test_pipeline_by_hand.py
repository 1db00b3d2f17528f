"""The whole pipeline against its five stages written once more in plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from stratalake.llm.queries import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str) -> list[str]:
    return WORD.findall(text)


def normal(line: str) -> str:
    return " ".join(words(line.lower()))


def shingles(text: str) -> frozenset:
    w = words(text.lower())
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def similar(a: frozenset, b: frozenset) -> bool:
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def classes(texts: list[str]) -> dict[str, int]:
    """A number for each text; near copies, also by way of others, share it."""
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if similar(sets[i], sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return dict(zip(texts, label))


def base_failed(text: str) -> bool:
    w = words(text)
    seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    twice = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    return len(w) < 20 or 100 * len(twice) > 30 * len(w)


def quality_rules(docs: dict) -> dict:
    held = defaultdict(set)  # (host, line): texts
    hosts = Counter(host for _, host in docs.values())
    for text, host in docs.values():
        for line in text.split("\n"):
            if words(line):
                held[host, normal(line)].add(text)
    limit = {host: max(20, n ** 0.5) for host, n in hosts.items()}
    often = {key: texts for key, texts in held.items() if len(texts) > limit[key[0]]}
    one = classes(sorted(set().union(*often.values()))) if often else {}
    often = {key for key, texts in often.items() if len({one[t] for t in texts}) > limit[key[0]]}
    kept = {}
    for i, (text, host) in docs.items():
        lines = text.split("\n")
        left = [x for x in lines if (host, normal(x)) not in often]
        n, m = len(words(text)), sum(len(words(x)) for x in left)
        if not base_failed(text) and m >= 0.3 * n:
            kept[i] = ("\n".join(left), host)
    return kept


def line_dedup(docs: dict) -> dict:
    sites = defaultdict(set)
    for text, host in docs.values():
        for line in text.split("\n"):
            sites[normal(line)].add(host)
    wide = {line for line, own in sites.items() if line and len(own) >= 10}
    cut = {}
    heavy = {i: text for i, (text, _) in docs.items() if 2 * sum(
        len(words(x)) for x in text.split("\n") if normal(x) in wide) > len(words(text))}
    for i, (text, host) in docs.items():
        copied = i in heavy and any(
            j != i and similar(shingles(text), shingles(t)) for j, t in heavy.items())
        left = [x for x in text.split("\n") if copied or normal(x) not in wide]
        cut[i] = ("\n".join(left), host)
    return cut


def near_dedup(docs: dict) -> dict:
    label = classes(sorted({text for text, _ in docs.values()}))
    first: dict[int, int] = {}
    for i in sorted(docs):
        first.setdefault(label[docs[i][0]], i)
    return {i: docs[i] for i in first.values()}


def secrets(docs: dict) -> dict:
    pattern = re.compile(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}""")
    return {i: (pattern.sub("<secret>", text), host) for i, (text, host) in docs.items()}


def pack(docs: dict) -> dict:
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for i, (text, _) in docs.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            found[i, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    return found


def fixture() -> dict:
    """Clean texts, stubs, junk, a line all over one host, a menu on many hosts, copies, secrets."""
    random = np.random.default_rng(11)

    def prose(name: str, n: int = 40) -> str:
        own = [f"{name}{k}" for k in range(n)]
        return "\n".join(" ".join(own[k:k + 10]) for k in range(0, n, 10))

    menu = "\n".join(f"menu entry {k} of all these sites" for k in range(3))
    texts = [(prose(f"clean{i}x"), f"s{i % 14}") for i in range(20)]
    texts += [(f"share this page with your friends\n{prose(f'host{i}x')}", "hot") for i in range(30)]
    texts += [(f"{menu}\n{prose(f'paged{i}x', 30)}", f"s{i}") for i in range(12)]
    texts += [(f"{menu}\nonly {i} stub{i} words{i} here{i}", f"s{i}") for i in range(3)]
    texts += [("too short", "s1"), (" ".join(["the same eight words again and again here"] * 9), "s2")]
    base = prose("copied", 100).split(" ")
    for i in range(50):  # near copies on one host, and on many
        own = list(base)
        own[int(random.integers(1, len(own) - 1))] = f"edit{i}"
        texts.append((" ".join(own), "hot" if i % 5 else f"s{i // 5}"))
    texts += [(prose("exact"), "s3")] * 4
    texts += [(f"{prose('secret')}\ntoken: abcdef0123456789ABC end", "s4"),
              (f'{prose("other")}\nthe password="Xy12345678901" is here', "s5")]
    texts.append((prose("long", 6000), "s6"))
    return dict(enumerate(texts))


def test_pipeline_by_hand(spark, tmp_path):
    docs = fixture()
    rows = [(i, text, "en", host, len(text)) for i, (text, host) in docs.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = {"quality_rules": quality_rules, "line_dedup": line_dedup, "near_dedup": near_dedup,
                "secrets": secrets}[name](docs)
        frame = corpus_pipeline.stored(stage(spark, frame, str(tmp_path)))
        found = {r.doc_id: (r.text, r.source) for r in frame.collect()}
        assert found == docs, name
        assert all(r.n_chars == len(r.text) for r in frame.collect())
    assert any("<secret>" in text for text, _ in docs.values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed} == pack(docs)
    used = defaultdict(list)
    for r in packed:
        used[r.sequence_id].append((r.offset, r.length))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
