"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters of a window, and of the part that it shares with the next one.
LENGTH = 96
STRIDE = 48
#: ASCII, and one symbol for all else; 0 pads short windows.
SYMBOLS, OTHER = 129, 128
EMBEDDED, HIDDEN = 12, 24


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(codes < OTHER, codes, OTHER).astype(np.uint8)


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    """log(sum(exp(x)))"""
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + np.squeeze(most, axis)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Scores for the tags of each character of a window; the tags are 0 (none) and, for each kind, first and later.

    Both directions run in one array: index 0 reads forward, 1 backward.
    """

    def __init__(self, kinds: int, seed: int = 0):
        rng, self.tags = np.random.default_rng(seed), 1 + 2 * kinds
        normal = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        self.weights = {
            "embedding": normal(SYMBOLS, EMBEDDED, scale=0.5),
            "input": normal(2, EMBEDDED, 4 * HIDDEN, scale=EMBEDDED**-0.5),
            "hidden": normal(2, HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5),
            "bias": np.zeros((2, 1, 4 * HIDDEN), np.float32),
            "output": normal(2 * HIDDEN, self.tags, scale=(2 * HIDDEN) ** -0.5),
            "output_bias": np.zeros(self.tags, np.float32),
            "steps": np.zeros((self.tags, self.tags), np.float32),
            "start": np.zeros(self.tags, np.float32),
        }
        self.weights["bias"][:, :, HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def _states(self, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Outputs of both directions, ``[position, window, 2 * HIDDEN]``; ``keep`` gets what training needs."""
        w, (n, length) = self.weights, windows.shape
        given = w["embedding"][windows.T]
        both = np.stack([given, given[::-1]])
        moved = (both.reshape(2, length * n, EMBEDDED) @ w["input"] + w["bias"]).reshape(2, length, n, 4 * HIDDEN)
        h = c = np.zeros((2, n, HIDDEN), np.float32)
        out = np.empty((2, length, n, HIDDEN), np.float32)
        for t in range(length):
            z = moved[:, t] + h @ w["hidden"]
            gates, new = _sigmoid(z[..., : 3 * HIDDEN]), np.tanh(z[..., 3 * HIDDEN :])
            before, c = (h, c), gates[..., HIDDEN : 2 * HIDDEN] * c + gates[..., :HIDDEN] * new
            bent = np.tanh(c)
            h = out[:, t] = gates[..., 2 * HIDDEN :] * bent
            if keep is not None:
                keep.append((*before, gates, new, bent))
        if keep is not None:
            keep.append(both)
        return np.concatenate([out[0], out[1, ::-1]], axis=2)

    def _emissions(self, states: np.ndarray) -> np.ndarray:
        return states @ self.weights["output"] + self.weights["output_bias"]

    def _forward(self, emitted: np.ndarray) -> np.ndarray:
        """Log weight of all taggings up to each position, by its tag."""
        steps, found = self.weights["steps"], np.empty_like(emitted)
        found[0] = emitted[0] + self.weights["start"]
        for t in range(1, len(emitted)):
            found[t] = emitted[t] + _total(found[t - 1][:, :, None] + steps, 1)
        return found

    def _backward(self, emitted: np.ndarray) -> np.ndarray:
        """Log weight of all taggings behind each position, by its tag."""
        steps, found = self.weights["steps"], np.zeros_like(emitted)
        for t in range(len(emitted) - 2, -1, -1):
            found[t] = _total((emitted[t + 1] + found[t + 1])[:, None, :] + steps, 2)
        return found

    def _gradients(self, windows: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log likelihood of ``tags``."""
        w, (n, length), keep = self.weights, windows.shape, []
        states = self._states(windows, keep)
        both, emitted = keep.pop(), self._emissions(states)
        ahead, behind = self._forward(emitted), self._backward(emitted)
        total = _total(ahead[-1], 1)
        share = np.exp(ahead + behind - total[:, None])
        gold = np.eye(self.tags, dtype=np.float32)[tags.T]
        d_emitted = (share - gold) / n
        d_steps = np.zeros_like(w["steps"])
        for t in range(1, length):
            pair = ahead[t - 1][:, :, None] + w["steps"] + (emitted[t] + behind[t])[:, None, :]
            d_steps += np.exp(pair - total[:, None, None]).sum(axis=0) - gold[t - 1].T @ gold[t]
        flat, d_flat = states.reshape(-1, 2 * HIDDEN), d_emitted.reshape(-1, self.tags)
        found = {"steps": d_steps / n, "start": d_emitted[0].sum(axis=0), "output": flat.T @ d_flat, "output_bias": d_flat.sum(axis=0)}
        d_states = d_emitted @ w["output"].T
        d_out = np.stack([d_states[..., :HIDDEN], d_states[::-1, :, HIDDEN:]])
        d_h = d_c = np.zeros((2, n, HIDDEN), np.float32)
        d_moved = np.empty((2, length, n, 4 * HIDDEN), np.float32)
        d_hidden = np.zeros_like(w["hidden"])
        for t in range(length - 1, -1, -1):
            h, c, gates, new, bent = keep[t]
            taken, kept, shown = gates[..., :HIDDEN], gates[..., HIDDEN : 2 * HIDDEN], gates[..., 2 * HIDDEN :]
            d_h = d_h + d_out[:, t]
            d_c = d_c + d_h * shown * (1 - bent * bent)
            z = d_moved[:, t]
            z[..., :HIDDEN] = d_c * new * taken * (1 - taken)
            z[..., HIDDEN : 2 * HIDDEN] = d_c * c * kept * (1 - kept)
            z[..., 2 * HIDDEN : 3 * HIDDEN] = d_h * bent * shown * (1 - shown)
            z[..., 3 * HIDDEN :] = d_c * taken * (1 - new * new)
            d_hidden += h.transpose(0, 2, 1) @ z
            d_h, d_c = z @ w["hidden"].transpose(0, 2, 1), d_c * kept
        d_flat = d_moved.reshape(2, length * n, 4 * HIDDEN)
        found |= {"hidden": d_hidden, "bias": d_flat.sum(axis=1, keepdims=True)}
        found["input"] = both.reshape(2, length * n, EMBEDDED).transpose(0, 2, 1) @ d_flat
        d_both = (d_flat @ w["input"].transpose(0, 2, 1)).reshape(2, length, n, EMBEDDED)
        found["embedding"] = np.zeros_like(w["embedding"])
        np.add.at(found["embedding"], windows.T, d_both[0] + d_both[1, ::-1])
        return found

    def train(self, batches: Iterator[tuple[np.ndarray, np.ndarray]], rate: float = 0.01) -> None:
        """Adam with a falling rate over the batches, which are ``(windows, tags)``."""
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step, (windows, tags) in enumerate(batches, start=1):
            found = self._gradients(windows, tags)
            size = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
            for k, g in found.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                moved = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] -= (rate / (1 + step / 200)) * moved

    def spans(self, windows: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """Per window the spans of its best tagging: start, stop, kind, and the spans' probability.

        The probability is that of all taggings which have just this span.
        """
        emitted = self._emissions(self._states(windows))
        length, n, _ = emitted.shape
        steps, best = self.weights["steps"], emitted[0] + self.weights["start"]
        back = np.zeros(emitted.shape, np.int64)
        for t in range(1, length):
            ways = best[:, :, None] + steps
            back[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + emitted[t]
        path, rows = np.empty((length, n), np.int64), np.arange(n)
        path[-1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            path[t - 1] = back[t, rows, path[t]]
        found: list[list] = [[] for _ in range(n)]
        some = np.flatnonzero((path % 2 == 1).any(axis=0))
        if not len(some):
            return found
        ahead, behind = self._forward(emitted[:, some]), self._backward(emitted[:, some])
        total = _total(ahead[-1], 1)
        for column, i in enumerate(some.tolist()):
            tags, own = path[:, i], emitted[:, i]
            for start in np.flatnonzero(tags % 2 == 1).tolist():
                first, later, stop = int(tags[start]), int(tags[start]) + 1, start + 1
                weight = ahead[start, column, first]
                while stop < length and tags[stop] == later:
                    weight += steps[first if stop == start + 1 else later, later] + own[stop, later]
                    stop += 1
                if stop < length:
                    after = steps[later if stop > start + 1 else first] + own[stop] + behind[stop, column]
                    weight += _total(np.delete(after, later), 0)
                found[i].append((start, stop, (first - 1) // 2, float(np.exp(min(weight - total[column], 0)))))
        return found
