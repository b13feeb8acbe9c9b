"""A convolutional text classifier in numpy: hashed word embeddings, several filter widths, max pooling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textblocks as tb

#: Leading bytes of a word whose hash has an embedding of its own, beside the whole word's.
STEM_BYTES = 4


class ConvText:
    """Scores whole texts between 0 and 1.

    A word is a run of ASCII letters and digits or bytes of other characters, with A-Z lower-cased;
    its embedding is the sum of those of the hashes of the word and of its first bytes. For each
    width, filters slide over the words of a text and each keeps its largest value over the whole
    text. A text without words, or null, scores as its filters' biases do.
    """

    def __init__(self, buckets: int = 1 << 16, dim: int = 8, widths: tuple[int, ...] = (1, 2, 3), filters: int = 4, spread: float = 0.02, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.buckets, self.widths, self.filters = buckets, widths, filters
        self.salts = rng.integers(1, 2**62, 2, dtype=np.uint64)  # another seed, other words share a bucket
        self.embed = rng.normal(0, spread, (buckets, dim)).astype(np.float32)
        self.kernels = [rng.normal(0, 0.5 / w, (w, dim, filters)).astype(np.float32) for w in widths]
        self.bias = np.full((len(widths), filters), 0.0, np.float32)
        self.out = (np.tile([1.0, -1.0], filters)[:filters] * 0.3 * np.ones((len(widths), filters))).astype(np.float32)
        self.level = 0.0
        self.tables: np.ndarray | None = None

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Buckets (two a word) of all words of the texts, and the first word of each text."""
        w = tb.words(texts, alnum=True)
        stems = tb.Words(w.raw, w.starts, np.minimum(w.ends, w.starts + STEM_BYTES), w.first)
        both = [tb.word_hashes(x, lower=True) ^ k for k, x in zip(self.salts, (w, stems), strict=True)]
        return np.stack([(tb.mix(h) & np.uint64(self.buckets - 1)).astype(np.int32) for h in both], 1), w.first

    @staticmethod
    def _inside(first: np.ndarray, n: int, width: int) -> np.ndarray:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        return text[width - 1 :] == text[: n - width + 1] if n >= width else np.zeros(0, dtype=bool)

    def _pool(self, values: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
        """The largest value of each filter in each text; minus infinity where a text has no window."""
        out = np.full((len(first) - 1, self.filters), -np.inf, np.float32)
        if len(values):
            values[~self._inside(first, len(values) + width - 1, width)] = -np.inf
            some = np.flatnonzero((np.diff(first) > 0) & (first[:-1] < len(values)))
            if len(some):
                out[some] = np.maximum.reduceat(values, first[some], axis=0)
        return out

    def _logit(self, pooled: list[np.ndarray]) -> np.ndarray:
        return sum(np.maximum(0, np.where(np.isinf(z), 0, z) + b) @ o for z, b, o in zip(pooled, self.bias, self.out, strict=True)) + self.level

    def fit(self, texts: pa.Array, y: np.ndarray, weights: np.ndarray, epochs: int | None = None, batch: int = 16, rate: float = 0.1, decay: float = 1e-4, drop: float = 0.5, seed: int = 5) -> ConvText:
        """Adagrad on the weighted log loss; a fixed seed makes reruns agree.

        Without ``epochs`` there are 20, and up to 60 for small samples. In each, every word of a text is left out with probability ``drop``, so that a text's
        label is not explained by one word that no other text has.
        """
        rng = np.random.default_rng(seed)
        epochs = epochs or int(np.clip(16_000 / max(1, len(y)), 20, 60))
        ids, first = self.features(texts)
        sums = [np.full(self.buckets, 1e-2, np.float32), [np.full_like(k, 1e-2) for k in self.kernels], np.full_like(self.bias, 1e-2), np.full_like(self.out, 1e-2), 1e-2]
        mean = float(np.average(y, weights=weights)) if len(y) else 0.0
        self.level = float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                own = [ids[first[r] : first[r + 1]] for r in rows]
                own = [x[rng.random(len(x)) >= drop] if len(x) > 20 else x for x in own]
                starts = np.concatenate([[0], np.cumsum([len(x) for x in own])])
                flat = np.concatenate(own)
                x = self.embed[flat[:, 0]] + self.embed[flat[:, 1]]
                tops, where = [], []
                for k in self.kernels:
                    width = len(k)
                    n = len(x) - width + 1
                    v = sum(x[j : j + n] @ k[j] for j in range(width)) if n > 0 else np.zeros((0, self.filters), np.float32)
                    tops.append(self._pool(v, starts, width))
                    where.append([starts[i] + v[starts[i] : starts[i + 1]].argmax(0) if np.isfinite(tops[-1][i]).all() else None for i in range(len(rows))])
                p = 1 / (1 + np.exp(-np.clip(self._logit(tops), -30, 30)))
                error = ((p - y[rows]) * weights[rows] / len(rows)).astype(np.float32)
                slots, moves = [], []
                for m, k in enumerate(self.kernels):
                    z = np.where(np.isinf(tops[m]), 0, tops[m]) + self.bias[m]
                    active = (z > 0) * error[:, None] * self.out[m]
                    g_out = (np.maximum(0, z) * error[:, None]).sum(0) + decay * self.out[m]
                    g_kernel = decay * k
                    for i, spots in enumerate(where[m]):
                        if spots is None or not active[i].any():
                            continue
                        for j in range(len(k)):
                            g_kernel[j] += x[spots + j].T * active[i]
                            moves.append(k[j].T * active[i][:, None])
                            slots.append(flat[spots + j])
                    for value, grad, total in ((self.out[m], g_out, sums[3][m]), (self.bias[m], active.sum(0), sums[2][m]), (k, g_kernel, sums[1][m])):
                        total += grad**2
                        value -= rate * grad / np.sqrt(total)
                self.level -= rate * 0.1 * float(error.sum())
                if slots:
                    slot, move = np.concatenate(slots), np.concatenate(moves)
                    used, back = np.unique(slot, return_inverse=True)
                    grad = np.zeros((len(used), move.shape[1]), np.float32)
                    back = back.reshape(slot.shape)
                    for c in range(2):
                        np.add.at(grad, back[:, c], move)
                    sums[0][used] += (grad**2).mean(1)
                    self.embed[used] -= rate * grad / np.sqrt(sums[0][used])[:, None]
        return self.freeze()

    def freeze(self) -> ConvText:
        """Multiply embeddings and filters into one table of a bucket's share in each filter's taps."""
        self.tables = np.concatenate([self.embed @ k[j] for k in self.kernels for j in range(len(k))], 1)
        return self

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "embed"}  # the tables are enough to score

    def logits(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        ids, first = self.features(texts)
        y = self.tables[ids[:, 0]]
        y += self.tables[ids[:, 1]]
        pooled, column, f = [], 0, self.filters
        for width in self.widths:
            n = len(y) - width + 1
            v = np.zeros((0, f), np.float32)
            if n > 0:
                v = y[:n, column : column + f].copy()
                for j in range(1, width):
                    v += y[j : j + n, column + j * f : column + (j + 1) * f]
            pooled.append(self._pool(v, first, width))
            column += width * f
        return self._logit(pooled).astype(np.float64)


class ConvTexts:
    """Several classifiers with different seeds, hence different hash collisions; scores come from the mean logit."""

    def __init__(self, seeds: tuple[int, ...] = (11, 12), **settings):
        self.nets = [ConvText(seed=s, **settings) for s in seeds]

    def fit(self, *data, **settings) -> ConvTexts:
        for net in self.nets:
            net.fit(*data, **settings)
        return self

    def logits(self, texts: pa.Array) -> np.ndarray:
        return sum(net.logits(texts) for net in self.nets) / len(self.nets)

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))
