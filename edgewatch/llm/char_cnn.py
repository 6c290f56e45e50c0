"""A small character convolutional network in numpy, with its training and calibration.

Input is a token with what stands left and right of it, as three runs of character codes. Each run goes
through the same embedding and convolution and is reduced to the maximum of every filter; a logistic
layer over the three maxima gives a logit, which is scaled to a probability on held-out examples.
"""

from __future__ import annotations

import numpy as np

CODES = 130  # 0 pads, 1..128 ASCII, 129 anything else
SIDE, MIDDLE = 24, 64
EMBED, FILTERS, KERNEL = 12, 32, 5
EPOCHS, BATCH, RATE = 6, 128, 3e-3


def codes(text: str, width: int, right: bool = False) -> np.ndarray:
    """The codes of a text of at most ``width`` characters, padded on the left if ``right``."""
    out = np.zeros(width, np.int64)
    own = np.minimum(np.array([ord(c) for c in text], np.int64), 128) + 1
    if len(own):
        out[slice(width - len(own), None) if right else slice(len(own))] = own
    return out


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Inputs that cover a whole token: one, or for long tokens several that overlap by half."""
    left = codes(text[max(start - SIDE, 0) : start], SIDE, right=True)
    right = codes(text[end : end + SIDE], SIDE)
    starts = range(start, max(end - MIDDLE // 2, start + 1), MIDDLE // 2)
    return [np.concatenate((left, codes(text[i : min(i + MIDDLE, end)], MIDDLE), right)) for i in starts]


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.3, (CODES, EMBED)).astype(np.float32)
        self.embed[0] = 0
        scale = (2 / (KERNEL * EMBED)) ** 0.5
        self.kernel = rng.normal(0, scale, (KERNEL * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)
        self.scale, self.shift = 1.0, 0.0
        self.threshold = 0.5

    def _parameters(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.out, self.offset]

    @staticmethod
    def _segments() -> list[slice]:
        return [slice(0, SIDE), slice(SIDE, SIDE + MIDDLE), slice(SIDE + MIDDLE, 2 * SIDE + MIDDLE)]

    def _forward(self, x: np.ndarray):
        """Logits and what the gradient needs."""
        kept, pooled = [], []
        for segment in self._segments():
            own = np.pad(x[:, segment], ((0, 0), (KERNEL // 2, KERNEL // 2)))
            taps = np.stack([own[:, i : own.shape[1] - KERNEL + 1 + i] for i in range(KERNEL)], axis=2)
            flat = self.embed[taps].reshape(*taps.shape[:2], -1)
            filtered = np.maximum(flat @ self.kernel + self.bias, 0)
            best = filtered.argmax(axis=1)
            pooled.append(np.take_along_axis(filtered, best[:, None], 1)[:, 0])
            kept.append((taps, flat, best))
        pool = np.concatenate(pooled, axis=1)
        return pool @ self.out + self.offset[0], pool, kept

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        logits, pool, kept = self._forward(x)
        error = ((1 / (1 + np.exp(-logits)) - y) / len(y)).astype(np.float32)
        grads = [np.zeros_like(p) for p in self._parameters()]
        grads[3], grads[4][0] = pool.T @ error, error.sum()
        down = error[:, None] * self.out
        rows = np.arange(len(y))[:, None]
        for i, (taps, flat, best) in enumerate(kept):
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            live = down[:, part] * (pool[:, part] > 0)
            inputs = flat[rows, best]  # row, filter, kernel x embedding
            grads[1] += np.einsum("nf,nfk->kf", live, inputs)
            grads[2] += live.sum(axis=0)
            back = live[:, :, None] * self.kernel.T
            np.add.at(grads[0], taps[rows, best], back.reshape(*best.shape, KERNEL, EMBED))
        grads[0][0] = 0
        return grads

    def fit(self, x: np.ndarray, y: np.ndarray, recall: float, seed: int = 11) -> Network:
        """Train on four fifths; scale and set the threshold on the rest.

        The threshold is the greatest that still finds a share of ``recall`` of the held-out positives.
        """
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        held, train = order[: len(y) // 5], order[len(y) // 5 :]
        first = [np.zeros_like(p) for p in self._parameters()]
        second = [np.zeros_like(p) for p in self._parameters()]
        step = 0
        for _ in range(EPOCHS):
            for batch in np.array_split(rng.permutation(train), max(1, len(train) // BATCH)):
                step += 1
                gradients = self._gradient(x[batch], y[batch])
                for p, g, m, v in zip(self._parameters(), gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self._calibrate(self.logits(x[held]), y[held])
        found = np.sort(self.probabilities(x[held])[y[held] > 0])
        if len(found):
            self.threshold = float(found[int((1 - recall) * len(found))])
        return self

    def _calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        """Scale and shift of the logits by Newton steps, with targets kept off 0 and 1."""
        n1, n0 = (y > 0).sum(), (y == 0).sum()
        target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        weights, basis = np.array([1.0, 0.0]), np.stack((logits, np.ones_like(logits)), axis=1).astype(np.float64)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(basis @ weights, -30, 30)))
            slope = basis.T @ (p - target) + 1e-3 * (weights - [1, 0])
            curve = (basis * (p * (1 - p))[:, None]).T @ basis + 1e-3 * np.eye(2)
            weights = weights - np.linalg.solve(curve, slope)
        if weights[0] > 0:
            self.scale, self.shift = map(float, weights)

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self._forward(x[i : i + 512])[0] for i in range(0, len(x), 512)]
        return np.concatenate(parts) if parts else np.empty(0, np.float32)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) * self.scale + self.shift, -30, 30)))
