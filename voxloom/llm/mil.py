"""Attention-based multiple-instance learning on passages, in numpy.

A document is a bag of passages of ``PASSAGE`` consecutive words. Each passage is encoded as a vector;
gated attention, learned from the documents' labels alone, weighs the vectors; the weighted sum is the
document's representation, from which a logistic unit scores it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textblocks as tb

#: Words of a passage; a document's last one may have fewer.
PASSAGE = 64
#: Words of the runs whose repetition within a text is a feature.
RUN = 5

# byte classes: 0 none, 1 lower case and other characters, 2 A-Z, 3 digits, 4 and on one per other ASCII byte
_CLASS = np.full(256, 1, np.int64)
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 3
for _byte in [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]:
    _CLASS[_byte] = 4 + _byte
_CLASSES = 4 + 0x80
_TURN = np.random.default_rng(41).integers(1, 2**63, (_CLASSES, _CLASSES), dtype=np.uint64)


def _shapes(w: tb.Words) -> np.ndarray:
    """A hash of the turns from one class of byte to another in each word: its shape, whatever its length."""
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    kind = _CLASS[w.raw]
    before = np.empty_like(kind)
    before[0], before[1:] = 0, kind[:-1]
    before[w.starts] = 0
    turn = np.flatnonzero(before != kind)
    total = np.zeros(len(turn) + 1, np.uint64)
    np.cumsum(_TURN[before[turn], kind[turn]], out=total[1:])
    return tb.mix(total[np.searchsorted(turn, w.ends)] - total[np.searchsorted(turn, w.starts)])


def _repeated(w: tb.Words, h: np.ndarray) -> np.ndarray:
    """Which words begin a run of RUN words that occurs more than once in their text."""
    out = np.zeros(len(h), np.float32)
    inside = np.flatnonzero(tb.inside_text(w, RUN))
    if len(inside):
        keys = tb.window_hashes(h, RUN)[inside] ^ tb.mix(w.text_of_word()[inside].astype(np.uint64) + np.uint64(1))
        _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
        out[inside] = count[back] > 1
    return out


class Mil:
    """The model. Null and empty texts have one passage without words, whose vector is all zero."""

    def __init__(self, words: int = 1 << 13, shapes: int = 1 << 10, dim: int = 12, hidden: int = 12, gate: int = 8, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.words, self.shapes, self.extra = words, shapes, 5
        size = lambda *shape, by=0.3: rng.normal(0, by, shape).astype(np.float64)
        self.p = {
            "embed": size(words + shapes, dim, by=0.02), "enc": size(dim + self.extra, hidden, by=0.4), "enc_b": np.zeros(hidden),
            "v": size(hidden, gate), "u": size(hidden, gate), "att": size(gate), "out": size(hidden), "level": np.zeros(1),
        }

    def bags(self, texts: pa.Array) -> tuple:
        """Buckets of all words (hash and shape), first word of each passage, its other features, first passage of each text."""
        w = tb.words(texts)
        h = tb.word_hashes(w, lower=True)
        ids = np.stack([(h & np.uint64(self.words - 1)).astype(np.int32), self.words + (_shapes(w) & np.uint64(self.shapes - 1)).astype(np.int32)], 1)
        n = w.counts
        parts = np.maximum(1, -(-n // PASSAGE))
        first = np.concatenate([[0], np.cumsum(parts)])
        text = np.repeat(np.arange(len(n)), parts)
        nth = np.arange(first[-1]) - first[text]
        begin = w.first[text] + nth * PASSAGE
        count = np.minimum(PASSAGE, n[text] - nth * PASSAGE)
        some = np.flatnonzero(count > 0)
        length = np.log1p((w.ends - w.starts).astype(np.float32))
        word_text = w.text_of_word()
        new = np.ones(len(h), np.float32)
        if len(h):
            order = np.lexsort((h, word_text))
            same = (h[order][1:] == h[order][:-1]) & (word_text[order][1:] == word_text[order][:-1])
            new[order[1:][same]] = 0
        extra = np.zeros((len(text), self.extra))
        for c, values in enumerate((_repeated(w, h), length, new)):
            if len(some):
                extra[some, c] = np.add.reduceat(values, begin[some]) / count[some]
        extra[:, 3] = np.log1p(n[text]) / 5
        extra[:, 4] = n[text] < 2 * RUN
        return ids, begin, count, extra, first

    def _means(self, bag: tuple) -> np.ndarray:
        ids, begin, count, extra, _ = bag
        out = np.zeros((len(begin), self.p["embed"].shape[1]))
        some = np.flatnonzero(count > 0)
        if len(some):
            rows = self.p["embed"][ids[:, 0]]
            rows += self.p["embed"][ids[:, 1]]
            out[some] = np.add.reduceat(rows, begin[some], axis=0) / count[some][:, None]
        return np.concatenate([out, extra], 1)

    def _forward(self, bag: tuple) -> dict:
        p, first = self.p, bag[4]
        x = self._means(bag)
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        v, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-h @ p["u"]))
        e = (v * u) @ p["att"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), np.diff(first)))
        a = e / np.repeat(np.add.reduceat(e, first[:-1]), np.diff(first))
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "logit": z @ p["out"] + p["level"][0]}

    def _backward(self, bag: tuple, f: dict, error: np.ndarray) -> dict:
        p, (ids, begin, count, _, first) = self.p, bag
        of = np.repeat(np.arange(len(error)), np.diff(first))
        g = {"out": f["z"].T @ error, "level": np.array([error.sum()])}
        dz = error[:, None] * p["out"]
        da = (dz[of] * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first[:-1])[of])
        dh = f["a"][:, None] * dz[of]
        g["att"] = (f["v"] * f["u"]).T @ de
        dv, du = de[:, None] * p["att"] * f["u"] * (1 - f["v"] ** 2), de[:, None] * p["att"] * f["v"] * f["u"] * (1 - f["u"])
        g["v"], g["u"] = f["h"].T @ dv, f["h"].T @ du
        dh += dv @ p["v"].T + du @ p["u"].T
        dx = dh * (1 - f["h"] ** 2)
        g["enc"], g["enc_b"] = f["x"].T @ dx, dx.sum(0)
        dm = (dx @ p["enc"].T)[:, : p["embed"].shape[1]] / np.maximum(1, count)[:, None]
        each = np.repeat(dm, np.maximum(0, count), axis=0)
        g["embed"] = np.zeros_like(p["embed"])
        for c in range(2):
            np.add.at(g["embed"], ids[:, c], each)
        return g

    def fit(self, texts: pa.Array, y: np.ndarray, weights: np.ndarray, epochs: int | None = None, batch: int = 24, rate: float = 0.01, decay: float = 1e-3, seed: int = 9) -> Mil:
        """Adam on the weighted log loss; a fixed seed makes reruns agree."""
        epochs = epochs or int(np.clip(12_000 / max(1, len(y)), 6, 40))
        rng = np.random.default_rng(seed)
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                bag = self.bags(texts.take(pa.array(rows)))
                f = self._forward(bag)
                error = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - y[rows]) * weights[rows] / len(rows)
                step += 1
                for k, g in self._backward(bag, f, error).items():
                    g = g + decay * self.p[k] * (k != "level")
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.p["embed"] = self.p["embed"].astype(np.float32)
        return self

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self._forward(self.bags(texts))["logit"], -30, 30)))
