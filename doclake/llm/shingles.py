"""Word shingles as 64-bit hashes, for whole batches of texts at once."""

from __future__ import annotations

from itertools import chain

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """Cache word -> 64-bit hash; bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= 1 << 18:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sequences(texts: list[str | None], cache: WordHashes, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, n_words): hashes[bounds[i]:bounds[i+1]] are text i's
    shingles in order. A-Z are lowered; words are runs of characters other
    than blank and 0x09-0x0D. A text of fewer words, but not none, is one
    shingle; a null or empty text has none."""
    split = [(t or "").encode().lower().split() for t in texts]
    n = np.array([len(w) for w in split], np.int64)
    total = int(n.sum())
    words = np.fromiter(map(cache.__getitem__, chain.from_iterable(split)), np.uint64, total)
    with np.errstate(over="ignore"):
        grams = words.copy()
        for k in range(1, width):
            grams[: total - k] = grams[: total - k] * _MULT + words[k:]
        grams = mix(grams ^ np.uint64(width))
    first = np.concatenate([[0], np.cumsum(n)])
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first[:-1] - bounds[:-1], count) + np.arange(int(count.sum()))
    out = grams[at]
    for i in np.flatnonzero((n > 0) & (n < width)):  # the whole text as one shingle
        h = int(n[i])
        for w in words[first[i]: first[i + 1]].tolist():
            h = (h * int(_MULT) + w) & 0xFFFFFFFFFFFFFFFF
        with np.errstate(over="ignore"):
            out[bounds[i]] = mix(np.array([h], np.uint64) ^ np.uint64(int(n[i])))[0]
    return out, bounds, n


def content_id(items: np.ndarray) -> int:
    """A signed 64-bit id of an array's content."""
    import xxhash
    h = xxhash.xxh64_intdigest(items.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h
