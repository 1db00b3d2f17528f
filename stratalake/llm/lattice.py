"""Subword lattices: all ways to spell words with the pieces of a fixed vocabulary.

A lattice has a node before and after each byte of a word and an edge for each piece that spells the
bytes between two nodes. The pieces of a batch of words are found together by walking a trie of the
vocabulary one byte further in each step. Sums over all paths are taken in log space, node by node
for all words at once, so words of any length neither underflow nor need a table of their own.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import sentencepiece

#: Where a word begins; no word holds a blank.
MARK = b" "
#: Scores up to here mark pieces that are not used.
_UNUSED = -1e8
#: Zipf's law in Mandelbrot's form: the frequency of rank r goes with 1 / (r + 2.7).
_SHIFT = 2.7


class Vocabulary(NamedTuple):
    """Byte strings in order, and the logarithms of their probabilities."""

    pieces: list[bytes]
    scores: np.ndarray


def vocabulary(path: str) -> Vocabulary:
    """The pieces of an existing vocabulary that lower-case words can hold, with its scores.

    Scores of whole numbers are ranks, as merges have them, and become Zipf's probabilities; others
    are logarithms of probabilities already. Single bytes are pieces of the last rank. Pieces that
    spell the same bytes are one.
    """
    loaded = sentencepiece.SentencePieceProcessor(model_file=path)
    size, found = loaded.get_piece_size(), {}
    scores = [loaded.get_score(i) for i in range(size)]
    plain = [i for i in range(size) if not (
        loaded.is_byte(i) or loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i))
        and scores[i] > _UNUSED]
    ranked = all(scores[i] == int(scores[i]) for i in plain)
    last = min((scores[i] for i in plain), default=0.0)
    for i in plain:
        piece = loaded.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:] and piece == piece.lower():
            found.setdefault(piece, []).append(scores[i])
    for byte in range(256):
        if byte != MARK[0]:
            found.setdefault(bytes([byte]), []).append(last)
    found.setdefault(MARK, []).append(last)
    weights = [sum(1 / (_SHIFT - s) if ranked else np.exp(s) for s in own) for own in found.values()]
    return Vocabulary(list(found), np.log(weights) - np.log(sum(weights)))


class Trie:
    """Pieces by the nodes that their bytes lead to; steps are looked up for many nodes at once."""

    def __init__(self, pieces: list[bytes]):
        nodes, ends = {b"": 0}, [-1]
        for number, piece in enumerate(pieces):
            for stop in range(1, len(piece) + 1):
                if piece[:stop] not in nodes:
                    nodes[piece[:stop]] = len(ends)
                    ends.append(-1)
            ends[nodes[piece]] = number
        steps = sorted((nodes[text[:-1]] << 8 | text[-1], node) for text, node in nodes.items() if text)
        self.keys, self.next = (np.array(part, np.int64) for part in zip(*steps))
        self.ends = np.array(ends, np.int64)

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The node that each byte leads to, -1 for none."""
        keys = nodes << 8 | data
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.next[at], -1)


class Lattices:
    """The lattices of some words, each after a mark."""

    def __init__(self, words: list[bytes], trie: Trie):
        marked = [MARK + word for word in words]
        data = np.frombuffer(b"".join(marked), np.uint8).astype(np.int64)
        size = np.array([len(word) for word in marked], np.int64)
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(words)), size)
        left = (first + size)[owner] - np.arange(len(data))  # bytes to the end of the word
        at, node = np.arange(len(data)), trie.step(np.zeros(len(data), np.int64), data)
        begins, widths, pieces, width = [], [], [], 1
        while True:
            on = node >= 0
            at, node = at[on], node[on]
            if not len(at):
                break
            piece = trie.ends[node]
            whole = piece >= 0
            begins.append(at[whole])
            pieces.append(piece[whole])
            widths.append(np.full(len(begins[-1]), width))
            more = left[at] > width
            at, node = at[more], node[more]
            node = trie.step(node, data[at + width])
            width += 1
        begin, self.piece = np.concatenate(begins), np.concatenate(pieces)
        self.word = owner[begin]
        # A word has one node more than bytes.
        self.start = begin + self.word
        self.stop = self.start + np.concatenate(widths)
        self.first = first + np.arange(len(words))
        self.last = self.first + size
        self.nodes = len(data) + len(words)

    def _summed(self, scores: np.ndarray, origin: np.ndarray, near: np.ndarray, far: np.ndarray,
                place: np.ndarray) -> np.ndarray:
        """Per node the log sum over the paths to ``origin`` nodes, whose edges lead from ``near`` to
        ``far``; ``place`` is how far the end of an edge is from its origin."""
        total = np.full(self.nodes, -np.inf)
        total[origin] = 0.0
        order = np.argsort(place * len(origin) + self.word)
        near, far, scores, place = near[order], far[order], scores[order], place[order]
        # Edges to one node follow each other; nodes at the same place do not depend on each other.
        group = np.flatnonzero(np.diff(far, prepend=-1))
        goal, where = far[group], place[group]
        cuts = np.flatnonzero(np.diff(where, prepend=-1, append=-1))
        edge = np.append(group, len(far))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x, y = edge[a], edge[b]
            total[goal[a:b]] = np.logaddexp.reduceat(total[near[x:y]] + scores[x:y], group[a:b] - x)
        return total

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """Per node the log probability of all spellings of the bytes before it."""
        return self._summed(scores[self.piece], self.first, self.start, self.stop,
                            self.stop - self.first[self.word])

    def likelihoods(self, scores: np.ndarray) -> np.ndarray:
        """Per word the log probability of all its spellings together."""
        return self.forward(scores)[self.last]

    def expected(self, scores: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each piece is used on average, where word ``k`` occurs ``times[k]`` times."""
        own = scores[self.piece]
        before = self.forward(scores)
        after = self._summed(own, self.last, self.stop, self.start, self.last[self.word] - self.start)
        share = np.exp(before[self.start] + own + after[self.stop] - before[self.last][self.word])
        return np.bincount(self.piece, share * times[self.word], len(scores))
