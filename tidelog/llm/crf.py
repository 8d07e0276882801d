"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

CHARS = 129  # ASCII, and one number for all the rest
HIDDEN = 12


def char_ids(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), CHARS - 1).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(gates: np.ndarray, u: np.ndarray, keep: bool):
    """Hidden states of ``gates`` (time, batch, 4H); with ``keep`` what the gradient needs."""
    steps, batch, wide = gates.shape
    hidden = wide // 4
    h, c = np.zeros((batch, hidden), gates.dtype), np.zeros((batch, hidden), gates.dtype)
    out, kept = np.empty((steps, batch, hidden), gates.dtype), []
    for t in range(steps):
        z = gates[t] + h @ u
        s = _sigmoid(z[:, : 3 * hidden])
        i, f, o, g = s[:, :hidden], s[:, hidden : 2 * hidden], s[:, 2 * hidden :], np.tanh(z[:, 3 * hidden :])
        before, c = c, f * c + i * g
        if keep:
            kept.append((h, before, c, i, f, o, g))
        h = out[t] = o * np.tanh(c)
    return out, kept


def _lstm_back(dout: np.ndarray, kept: list, u: np.ndarray):
    steps, batch, hidden = dout.shape
    dgates, du = np.empty((steps, batch, 4 * hidden), dout.dtype), np.zeros_like(u)
    dh, dc = np.zeros((batch, hidden), dout.dtype), np.zeros((batch, hidden), dout.dtype)
    for t in range(steps - 1, -1, -1):
        h, before, c, i, f, o, g = kept[t]
        dh = dh + dout[t]
        th = np.tanh(c)
        dc = dc + dh * o * (1 - th * th)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dgates[t] = dz
        du += h.T @ dz
        dh, dc = dz @ u.T, dc * f
    return dgates, du


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, tags: int, seed: int = 7, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)

        def init(*shape):
            return (rng.normal(size=shape) * 0.2).astype(np.float32)

        self.tags = tags
        self.weights = {
            "xf": init(CHARS, 4 * hidden), "xb": init(CHARS, 4 * hidden), "uf": init(hidden, 4 * hidden), "ub": init(hidden, 4 * hidden),
            "v": init(2 * hidden, tags), "b": init(tags), "a": init(tags, tags), "s": init(tags),
        }

    def _emissions(self, ids: np.ndarray, keep: bool = False):
        w, ids = self.weights, ids.T
        hf, kf = _lstm(w["xf"][ids], w["uf"], keep)
        hb, kb = _lstm(w["xb"][ids[::-1]], w["ub"], keep)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        return h @ w["v"] + w["b"], h, kf, kb

    def gradient(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of ``gold`` (batch, time) and its gradient."""
        w, (batch, steps) = self.weights, ids.shape
        e, h, kf, kb = self._emissions(ids, keep=True)
        gold, rows = gold.T, np.arange(batch)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = w["s"] + e[0]
        for t in range(1, steps):
            alpha[t] = _logsum(alpha[t - 1][:, :, None] + w["a"], 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(w["a"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsum(alpha[-1], 1)
        score = w["s"][gold[0]] + e[0, rows, gold[0]]
        de = np.exp(alpha + beta - total[None, :, None])
        da, ds = np.zeros_like(w["a"]), de[0].sum(axis=0)
        for t in range(1, steps):
            score = score + w["a"][gold[t - 1], gold[t]] + e[t, rows, gold[t]]
            pair = alpha[t - 1][:, :, None] + w["a"] + (e[t] + beta[t])[:, None, :] - total[:, None, None]
            da += np.exp(pair).sum(axis=0)
            np.subtract.at(da, (gold[t - 1], gold[t]), 1)
        np.subtract.at(ds, gold[0], 1)
        de[np.arange(steps)[:, None], rows[None, :], gold] -= 1
        de /= batch
        hidden = h.shape[2] // 2
        dh = de @ w["v"].T
        gf, duf = _lstm_back(dh[:, :, :hidden], kf, w["uf"])
        gb, dub = _lstm_back(dh[::-1, :, hidden:], kb, w["ub"])
        dxf, dxb = np.zeros_like(w["xf"]), np.zeros_like(w["xb"])
        np.add.at(dxf, ids.T, gf)
        np.add.at(dxb, ids.T[::-1], gb)
        flat = de.reshape(-1, self.tags)
        return float((total - score).mean()), {
            "xf": dxf, "xb": dxb, "uf": duf, "ub": dub, "v": h.reshape(-1, 2 * hidden).T @ flat, "b": flat.sum(axis=0),
            "a": da / batch, "s": ds / batch,
        }

    def fit(self, ids: np.ndarray, gold: np.ndarray, steps: int, batch: int = 32, rate: float = 0.02, seed: int = 7) -> float:
        """Adam on random batches, always in the same order; gives the last mean loss."""
        rng, loss = np.random.default_rng(seed), 0.0
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            some = rng.integers(0, len(ids), batch)
            now, slope = self.gradient(ids[some], gold[some])
            loss = now if step == 1 else 0.9 * loss + 0.1 * now
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in slope.items():
                g = np.clip(g, -1, 1)
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                self.weights[k] -= (pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return loss

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tags (batch, time) by Viterbi."""
        w, e = self.weights, self._emissions(ids)[0]
        back = np.empty(e.shape, np.int8)
        best = w["s"] + e[0]
        for t in range(1, len(e)):
            scores = best[:, :, None] + w["a"]
            back[t] = scores.argmax(axis=1)
            best = scores.max(axis=1) + e[t]
        out = np.empty(ids.shape, np.int64)
        at, rows = best.argmax(axis=1), np.arange(len(ids))
        for t in range(len(e) - 1, -1, -1):
            out[:, t] = at
            at = back[t, rows, at].astype(np.int64)
        return out
