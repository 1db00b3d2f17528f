"""A character-level bidirectional LSTM with a CRF over its scores, in numpy: training and decoding.

Characters are coded by ``codes``; code 0 pads. Tags are 0 for outside and, for kind ``k``, ``1 + 2k``
for its first and ``2 + 2k`` for its further characters.
"""

from __future__ import annotations

import numpy as np

ALPHABET = 99
_LOW = np.full(128, 96, np.int64)
_LOW[32:127] = np.arange(1, 96)
BARRED = np.float32(-1e4)


def codes(text: str) -> np.ndarray:
    """Printable ASCII apart, then control characters, letters beyond ASCII, anything else."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, _LOW[np.minimum(points, 127)], np.where(points >= 0xC0, 97, 98))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    def __init__(self, kinds: int, width: int = 12, hidden: int = 20, seed: int = 5):
        random = np.random.default_rng(seed)
        self.tags, self.hidden = 1 + 2 * kinds, hidden

        def matrix(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"embed": matrix(ALPHABET, width) * 3, "out": matrix(2 * hidden, self.tags),
                  "out_b": np.zeros(self.tags, np.float32),
                  "step": np.zeros((self.tags, self.tags), np.float32)}
        for side in "fb":
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p |= {f"{side}_in": matrix(width, 4 * hidden),
                       f"{side}_own": matrix(hidden, 4 * hidden), f"{side}_b": bias}

    def _steps(self) -> np.ndarray:
        """Transition scores; a further character of a kind follows only that kind."""
        barred = np.zeros((self.tags, self.tags), np.float32)
        for tag in range(2, self.tags, 2):
            barred[:, tag] = BARRED
            barred[[tag - 1, tag], tag] = 0
        return self.p["step"] + barred

    def _run(self, x: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        """Hidden states [batch, time, hidden]; ``side`` b reads from the end."""
        own, n = self.p[f"{side}_own"], self.hidden
        given = x @ self.p[f"{side}_in"] + self.p[f"{side}_b"]
        h = np.zeros((len(x), n), np.float32)
        c, out = h, np.empty((*x.shape[:2], n), np.float32)
        order = range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1)
        for t in order:
            z = given[:, t] + h @ own
            gate = _sigmoid(z[:, :3 * n])
            i, f, o, g = gate[:, :n], gate[:, n:2 * n], gate[:, 2 * n:], np.tanh(z[:, 3 * n:])
            before, before_h = c, h
            c = f * before + i * g
            tanh = np.tanh(c)
            h = o * tanh
            out[:, t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before, tanh, before_h))
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores of coded windows [batch, time]."""
        given = self.p["embed"][x]
        states = np.concatenate([self._run(given, side, None) for side in "fb"], axis=2)
        return states @ self.p["out"] + self.p["out_b"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the windows and its gradients."""
        batch, time = x.shape
        given, kept = self.p["embed"][x], {"f": [], "b": []}
        states = np.concatenate([self._run(given, s, kept[s]) for s in "fb"], axis=2)
        score = states @ self.p["out"] + self.p["out_b"]
        step = self._steps()
        # Forward and backward sums of the CRF; a window starts outside of any span.
        start = np.where(np.arange(self.tags) % 2 == 0, BARRED, 0).astype(np.float32)
        start[0] = 0
        ahead, behind = np.empty_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + start
        for t in range(1, time):
            ahead[:, t] = score[:, t] + _logsum(ahead[:, t - 1, :, None] + step, 1)
        for t in range(time - 2, -1, -1):
            behind[:, t] = _logsum(step + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        total = _logsum(ahead[:, -1], 1)
        d_score = np.exp(ahead + behind - total[:, None, None])
        pair = np.exp(ahead[:, :-1, :, None] + step + (score + behind)[:, 1:, None, :]
                      - total[:, None, None, None])
        d_step = pair.sum(axis=(0, 1))
        np.add.at(d_step, (y[:, :-1], y[:, 1:]), -1)
        rows, cols = np.arange(batch)[:, None], np.arange(time)
        gold = score[rows, cols, y].sum(1) + step[y[:, :-1], y[:, 1:]].sum(1) + start[y[:, 0]]
        d_score[rows, cols, y] -= 1
        d_score = (d_score / batch).astype(np.float32)
        grad = {"out": states.reshape(-1, 2 * self.hidden).T @ d_score.reshape(-1, self.tags),
                "out_b": d_score.sum(axis=(0, 1)), "step": (d_step / batch).astype(np.float32)}
        d_states, n = d_score @ self.p["out"].T, self.hidden
        d_given = np.zeros_like(given)
        for place, side in enumerate("fb"):
            own, d_out = self.p[f"{side}_own"], d_states[:, :, place * n:(place + 1) * n]
            d_h = np.zeros((batch, n), np.float32)
            d_c, d_own = d_h, np.zeros_like(own)
            d_z_all = np.empty((batch, time, 4 * n), np.float32)
            for t, i, f, o, g, before, tanh, before_h in reversed(kept[side]):
                d_h = d_h + d_out[:, t]
                d_c = d_c + d_h * o * (1 - tanh * tanh)
                d_z = np.concatenate([
                    d_c * g * i * (1 - i), d_c * before * f * (1 - f),
                    d_h * tanh * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
                d_z_all[:, t] = d_z
                d_own += before_h.T @ d_z
                d_h, d_c = d_z @ own.T, d_c * f
            grad[f"{side}_own"], grad[f"{side}_b"] = d_own, d_z_all.sum(axis=(0, 1))
            grad[f"{side}_in"] = given.reshape(-1, given.shape[2]).T @ d_z_all.reshape(-1, 4 * n)
            d_given += d_z_all @ self.p[f"{side}_in"].T
        grad["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grad["embed"], x, d_given)
        return float((total - gold).mean()), grad

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 240, batch: int = 48,
            rate: float = 0.02, seed: int = 6) -> float:
        """Adam on random batches; returns the mean loss of the last tenth of the steps."""
        random, losses = np.random.default_rng(seed), []
        first = {name: np.zeros_like(value) for name, value in self.p.items()}
        second = {name: np.zeros_like(value) for name, value in self.p.items()}
        for step in range(1, steps + 1):
            rows = random.integers(0, len(x), min(batch, len(x)))
            loss, grad = self.gradients(x[rows], y[rows])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            pace = rate * min(1.0, 2.5 * (1 - step / (steps + 1)))
            for name, g in grad.items():
                g = g * min(1.0, 5 / max(norm, 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                self.p[name] = (self.p[name] - pace * first[name] / (1 - 0.9 ** step) / (
                    np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return float(np.mean(losses[-max(1, steps // 10):]))

    def decode(self, score: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Best tag sequences for scores [batch, time, tags] of the given lengths."""
        step, (batch, time, tags) = self._steps(), score.shape
        best = np.where(np.arange(tags) % 2 == 0, BARRED, 0).astype(np.float32)
        best[0] = 0
        best = score[:, 0] + best
        back = np.zeros((batch, time, tags), np.int8)
        ends = np.zeros((batch, tags), np.float32)
        ends[lengths == 1] = best[lengths == 1]
        for t in range(1, time):
            choice = best[:, :, None] + step
            back[:, t] = choice.argmax(axis=1)
            best = choice.max(axis=1) + score[:, t]
            ends[lengths == t + 1] = best[lengths == t + 1]
        paths = []
        for row, n in enumerate(lengths.tolist()):
            path = np.zeros(n, np.int64)
            if n:
                path[-1] = ends[row].argmax()
                for t in range(n - 1, 0, -1):
                    path[t - 1] = back[row, t, path[t]]
            paths.append(path)
        return paths
