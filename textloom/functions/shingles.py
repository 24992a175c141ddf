"""Sets of word shingles as hashes, and their min-max signatures."""

import numpy as np

from .words import lowered, mix, words

#: Signature values in a band: half as many permutations.
ROWS = 6
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)]


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int):
        self.words = words

    def __call__(self, text: str | None) -> np.ndarray:
        """Words are runs of bytes that aren't white space in ASCII, A-Z lower-cased. Fewer words than a shingle has are one; none are none."""
        h = words(lowered(text))[0]
        if not len(h):
            return h
        k = min(self.words, len(h))
        s = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            s = (s ^ (s >> np.uint64(29))) * _MIX[1] + h[i : len(h) - k + 1 + i] * _MIX[0]
        return np.unique(mix(s))


class Signer:
    """Band values of a set: each a hash of ROWS signature values, minima and maxima in turn."""

    def __init__(self, bands: int, rows: int = ROWS, seed: int = 0):
        rng, count = np.random.default_rng(seed), -(-bands * rows // 2)
        self.shape = bands, rows
        self.factor = (rng.integers(0, 2**31, count, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.offset = rng.integers(0, 2**32, count, dtype=np.uint32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
        low, high = np.full(len(self.factor), 2**32 - 1, np.uint32), np.zeros(len(self.factor), np.uint32)
        for k in range(0, len(x), 4096):
            y = x[k : k + 4096] * self.factor
            y += self.offset
            np.minimum(low, y.min(0), out=low)
            np.maximum(high, y.max(0), out=high)
        return np.stack([low, high], 1).ravel()[: self.shape[0] * self.shape[1]]

    def bands(self, shingles: np.ndarray) -> list[int]:
        import xxhash

        values = self.signature(shingles).reshape(self.shape)
        return np.array([xxhash.xxh3_64_intdigest(v.tobytes(), seed=i) for i, v in enumerate(values)], np.uint64).view(np.int64).tolist()
