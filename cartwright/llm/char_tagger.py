"""A character-level bidirectional LSTM with CRF transitions, trained and decoded in numpy.

Windows of equal length go through the network together. Labels are O and a begin and an inside label per kind.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EMBED, HIDDEN = 12, 16
BATCH, EPOCHS, RATE = 32, 14, 0.01
#: Character classes: printable ASCII by itself, then any letter, any other character, and padding.
OTHER_LETTER, OTHER, PAD, CLASSES = 95, 96, 97, 98


def encode(text: str, width: int) -> np.ndarray:
    """The classes of the characters of `text`, padded to `width`."""
    codes = np.full(width, PAD, dtype=np.int64)
    for i, c in enumerate(text[:width]):
        codes[i] = ord(c) - 32 if " " <= c <= "~" else OTHER_LETTER if c.isalpha() else OTHER
    return codes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (time, row, HIDDEN) of the inputs (time, row, EMBED); with `keep`, what the backward pass needs."""
    steps, rows, _ = x.shape
    h, c = np.zeros((rows, HIDDEN)), np.zeros((rows, HIDDEN))
    out, kept = np.empty((steps, rows, HIDDEN)), []
    for t in range(steps):
        joined = np.concatenate([x[t], h], axis=1)
        gates = joined @ w + b
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before, c = c, f * c + i * g
        tanh_c = np.tanh(c)
        h = o * tanh_c
        out[t] = h
        if keep:
            kept.append((joined, i, f, o, g, before, tanh_c))
    return out, kept


def _lstm_back(d_out: np.ndarray, kept: list, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the inputs, of the weights and of the bias."""
    steps, rows, _ = d_out.shape
    d_x, d_w, d_b = np.empty((steps, rows, EMBED)), np.zeros_like(w), np.zeros(4 * HIDDEN)
    d_h, d_c = np.zeros((rows, HIDDEN)), np.zeros((rows, HIDDEN))
    for t in reversed(range(steps)):
        joined, i, f, o, g, before, tanh_c = kept[t]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - tanh_c**2)
        d_gates = np.concatenate(
            [d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1
        )
        d_w += joined.T @ d_gates
        d_b += d_gates.sum(axis=0)
        d_joined = d_gates @ w.T
        d_x[t], d_h, d_c = d_joined[:, :EMBED], d_joined[:, EMBED:], d_c * f
    return d_x, d_w, d_b


@dataclass
class Tagger:
    """The parameters by name and the number of labels."""

    weights: dict[str, np.ndarray]
    labels: int

    @classmethod
    def fresh(cls, labels: int, seed: int = 7) -> Tagger:
        draw = np.random.default_rng(seed)
        gate = lambda: draw.normal(0, 0.2, (EMBED + HIDDEN, 4 * HIDDEN))
        bias = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        weights = {"embed": draw.normal(0, 0.3, (CLASSES, EMBED)), "forward": gate(), "forward_bias": bias.copy()}
        weights |= {"backward": gate(), "backward_bias": bias.copy()}
        weights |= {"out": draw.normal(0, 0.2, (2 * HIDDEN, labels)), "out_bias": np.zeros(labels)}
        return cls(weights | {"transitions": np.zeros((labels, labels))}, labels)

    def emissions(self, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Label scores (time, row, label) of windows of codes (row, time)."""
        p = self.weights
        x = p["embed"][codes.T]
        ahead, kept_ahead = _lstm(x, p["forward"], p["forward_bias"], keep)
        back, kept_back = _lstm(x[::-1], p["backward"], p["backward_bias"], keep)
        hidden = np.concatenate([ahead, back[::-1]], axis=2)
        return hidden @ p["out"] + p["out_bias"], (codes, hidden, kept_ahead, kept_back)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best label sequence (row, time) of each window under emissions and transitions."""
        scores, _ = self.emissions(codes)
        steps, rows, _ = scores.shape
        best, pointers = scores[0], np.empty((steps, rows, self.labels), dtype=np.int64)
        for t in range(1, steps):
            ways = best[:, :, None] + self.weights["transitions"][None]
            pointers[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        path = np.empty((rows, steps), dtype=np.int64)
        path[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = pointers[t, np.arange(rows), path[:, t]]
        return path

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The CRF loss per row and its gradients; forward-backward gives the expected labels and transitions."""
        scores, (codes, hidden, kept_ahead, kept_back) = self.emissions(codes, keep=True)
        steps, rows, n = scores.shape
        move, at, truth = self.weights["transitions"], np.arange(rows), labels.T
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = _logsumexp(ahead[t - 1][:, :, None] + move[None], 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = _logsumexp(move[None] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _logsumexp(ahead[-1], 1)
        d_scores = np.exp(ahead + behind - total[None, :, None])
        d_move = np.zeros_like(move)
        loss = total.sum()
        for t in range(steps):
            loss -= scores[t, at, truth[t]].sum()
            d_scores[t, at, truth[t]] -= 1
            if t:
                both = ahead[t - 1][:, :, None] + move[None] + (scores[t] + behind[t])[:, None, :] - total[:, None, None]
                d_move += np.exp(both).sum(axis=0)
                np.subtract.at(d_move, (truth[t - 1], truth[t]), 1)
                loss -= move[truth[t - 1], truth[t]].sum()
        p, d_scores = self.weights, d_scores / rows
        flat = hidden.reshape(-1, 2 * HIDDEN)
        grads = {"out": flat.T @ d_scores.reshape(-1, n), "out_bias": d_scores.sum(axis=(0, 1)), "transitions": d_move / rows}
        d_hidden = d_scores @ p["out"].T
        d_x, grads["forward"], grads["forward_bias"] = _lstm_back(d_hidden[:, :, :HIDDEN], kept_ahead, p["forward"])
        d_back, grads["backward"], grads["backward_bias"] = _lstm_back(
            d_hidden[::-1, :, HIDDEN:], kept_back, p["backward"]
        )
        grads["embed"] = np.zeros_like(p["embed"])
        np.add.at(grads["embed"], codes.T, d_x + d_back[::-1])
        return float(loss / rows), grads

    def train(self, codes: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses, step = [], 0
        for _ in range(epochs):
            order, seen = draw.permutation(len(codes)), []
            for begin in range(0, len(order), BATCH):
                batch = order[begin : begin + BATCH]
                loss, grads = self.gradients(codes[batch], labels[batch])
                seen.append(loss)
                step += 1
                for k, grad in grads.items():
                    grad = np.clip(grad, -5, 5)
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad**2
                    scale = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                    self.weights[k] -= RATE * first[k] / (1 - 0.9**step) / scale
            losses.append(float(np.mean(seen)))
        return losses
