"""A small convolutional text classifier in numpy: hashed words, several filter widths, max pooling."""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes that are no letters become blanks; letters of other scripts are kept as they are.
LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
#: Frequent words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that was with for this be are from by it",
    "fr": "le la les de des du et un une que pour dans est pas qui au",
    "de": "der die das und ist nicht mit den von ein eine zu auf für dem des",
    "es": "el la los las de que y en un una por con para se del no",
}
WIDTHS = (1, 2, 3)
#: Bytes of a word's beginning.
STEM = 4
#: Words whose filter responses are held at a time.
WORDS_AT_ONCE = 1 << 18


def word_ids(text: bytes, buckets: int) -> np.ndarray:
    """Two hash buckets for each word of a whole text: of the word and of how it begins.

    Words are in lower case, without marks and digits. A word's vector is the sum of both rows, so
    that forms not seen in training share what their stem has learned.
    """
    words = text.lower().translate(LETTERS).split()
    whole = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)) % (buckets // 2)
    stems = np.fromiter((zlib.crc32(w[:STEM]) for w in words), dtype=np.uint32, count=len(words)) % (buckets // 2)
    return np.stack([whole, stems + buckets // 2], axis=1).astype(np.uint16)


def _lined_up(texts: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All words in one row, each text followed by blanks (bucket ``buckets``), and where each text starts."""
    sizes = np.array([len(t) for t in texts]) + max(WIDTHS)
    starts = np.cumsum(sizes) - sizes
    ids = np.full((int(sizes.sum()) + max(WIDTHS), 2), buckets, dtype=np.int64)
    for t, s in zip(texts, starts):
        ids[s:s + len(t)] = t
    return ids, starts


class ConvNet:
    """Embeddings, one block of filters per width, the largest response of each filter, and a logistic output."""

    def __init__(self, buckets: int = 1 << 14, size: int = 16, filters: int = 8, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.buckets = buckets
        self.embed = draw.normal(0, 0.05, (buckets + 1, size)).astype(np.float32)
        self.embed[buckets] = 0
        self.filters = [draw.normal(0, 1 / np.sqrt(size * w), (w, size, filters)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), filters), dtype=np.float32)
        self.out = draw.normal(0, 0.3, (len(WIDTHS), filters)).astype(np.float32)
        self.base = np.float32(-1.0)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = 5, batch: int = 32, rate: float = 0.1,
            decay: float = 1e-4, seed: int = 11) -> ConvNet:
        """Adagrad on the logistic loss, both classes weighted alike; only the words behind a maximum move."""
        draw = np.random.default_rng(seed)
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        squares = [np.full_like(a, 1e-4) for a in (self.embed, *self.filters, self.bias, self.out)]
        base_square = 1e-4
        for _ in range(epochs):
            for at in np.array_split(draw.permutation(len(texts)), max(1, len(texts) // batch)):
                d_embed = np.zeros_like(self.embed)
                d_filters = [np.zeros_like(f) for f in self.filters]
                d_bias, d_out, d_base = np.zeros_like(self.bias), np.zeros_like(self.out), 0.0
                for i in at:
                    ids = np.concatenate([texts[i], np.full((max(WIDTHS), 2), self.buckets)]).astype(np.int64)
                    top, where = self._pooled(ids)
                    slope = (_sigmoid(float((top * self.out).sum() + self.base)) - labels[i]) * weight[i] / len(at)
                    d_out += slope * top
                    d_base += slope
                    back = slope * self.out * (top > 0)
                    d_bias += back
                    for k, w in enumerate(WIDTHS):
                        for step in range(w):
                            word = ids[where[k] + step]
                            d_filters[k][step] += (self.embed[word].sum(axis=1) * back[k][:, None]).T
                            for part in word.T:
                                np.add.at(d_embed, part, self.filters[k][step].T * back[k][:, None])
                d_embed[self.buckets] = 0
                parts = [self.embed, *self.filters, self.bias, self.out]
                for part, grad, square in zip(parts, [d_embed, *d_filters, d_bias, d_out], squares):
                    square += grad * grad
                    part -= rate * (grad / np.sqrt(square) + decay * part)
                base_square += d_base ** 2
                self.base -= np.float32(rate * d_base / np.sqrt(base_square))
        return self

    def _pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per width and filter the largest response (zero at least) in one text, and its place."""
        vectors = self.embed[ids[:, 0]] + self.embed[ids[:, 1]]
        n = len(ids) - max(WIDTHS) + 1
        top, where = np.empty_like(self.bias), np.empty(self.bias.shape, dtype=np.int64)
        for k, w in enumerate(WIDTHS):
            response = sum(vectors[step:step + n] @ self.filters[k][step] for step in range(w))
            where[k] = response.argmax(axis=0)
            top[k] = response[where[k], np.arange(response.shape[1])] + self.bias[k]
        return np.maximum(top, 0), where

    def frozen(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """The trained net with every bucket's share of every filter worked out, so that scoring only looks up and adds."""

    def __init__(self, net: ConvNet):
        self.buckets, self.bias, self.out, self.base = net.buckets, net.bias, net.out, float(net.base)
        self.shares = [[net.embed @ f[step] for step in range(len(f))] for f in net.filters]
        self.tongue = np.zeros((net.buckets + 1, len(FUNCTION_WORDS)), dtype=np.int32)
        for k, words in enumerate(FUNCTION_WORDS.values()):
            self.tongue[word_ids(words.encode(), net.buckets)[:, 0], k] = 1
        self.shift = np.zeros(len(FUNCTION_WORDS) + 1)

    def logits(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The net's output for each text, and its language (the last index: none told)."""
        totals, tongues, block, words = [], [], [], 0
        for i, text in enumerate(texts):
            block.append(text)
            words += len(text)
            if words >= WORDS_AT_ONCE or i + 1 == len(texts):
                total, counts = self._block(block)
                totals.append(total)
                tongues.append(np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), len(FUNCTION_WORDS)))
                block, words = [], 0
        return (np.concatenate(totals), np.concatenate(tongues)) if totals else (np.empty(0), np.empty(0, int))

    def _block(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids, starts = _lined_up(texts, self.buckets)
        n = len(ids) - max(WIDTHS)
        total = np.full(len(texts), self.base)
        bounds = np.stack([starts, starts + [len(t) + 1 for t in texts]], axis=1).ravel()
        for k, shares in enumerate(self.shares):
            response = shares[0][ids[:n, 0]] + shares[0][ids[:n, 1]]
            for step in range(1, len(shares)):
                for part in ids[step:n + step].T:
                    response += shares[step][part]
            top = np.maximum.reduceat(response, bounds)[::2]  # of a text's own windows; the odd ones reach into the next
            total += np.maximum(top + self.bias[k], 0) @ self.out[k].astype(float)
        return total, np.add.reduceat(self.tongue[ids[:n, 0]], starts)

    def calibrate(self, texts: list[np.ndarray], labels: np.ndarray, least: int = 40) -> Scorer:
        """Move each language's threshold to where the F1 of the toxic class is best, on rows the net did not see.

        A language with fewer than ``least`` rows, or with one class only, takes the threshold of all rows.
        """
        logits, tongues = self.logits(texts)
        general = _threshold(logits, labels, 0.0)
        for k in range(len(self.shift)):
            own = tongues == k
            self.shift[k] = _threshold(logits[own], labels[own], general) if own.sum() >= least else general
        return self

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Between 0 and 1; 0.5 is the threshold of the text's language."""
        logits, tongues = self.logits(texts)
        return _sigmoid(logits - self.shift[tongues]) if len(logits) else logits


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _threshold(logits: np.ndarray, labels: np.ndarray, otherwise: float) -> float:
    """Halfway between the last accepted and the first rejected logit of the cut with the best F1."""
    order = np.argsort(-logits, kind="stable")
    ranked, hit = logits[order], labels[order] == 1
    if not len(ranked) or hit.all() or not hit.any():
        return otherwise
    f1 = 2 * np.cumsum(hit) / (np.arange(1, len(hit) + 1) + hit.sum())
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)[-1]
    return float((ranked[best] + ranked[min(best + 1, len(ranked) - 1)]) / 2)
