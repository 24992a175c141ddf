"""Hashes of words and of runs of hashes, without a step for each word."""

import numpy as np

_rng = np.random.default_rng(5)
_BYTES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at once, unless a word is longer.
PIECE = 1 << 18
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers, at least, of the base and of its inverse."""
    if n > len(_powers[0]):
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, _INVERSE)]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hashes of any runs of a sequence, by prefix sums of a polynomial: equal for equal runs, wherever they are."""

    def __init__(self, values: np.ndarray):
        self.power, inverse = powers(len(values) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * inverse[: len(values)], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.power[start] + (stop - start).astype(np.uint64))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and stops of the words of a text's bytes: runs that aren't white space in ASCII."""
    space, out, at = SPACE[data], [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not space[end]:
            end = min(len(data), end + 1 + int(np.argmax(np.append(space[end + 1 : end + 1 + PIECE], True))))
        gap = np.concatenate([[True], space[at:end], [True]])
        start, stop = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        out.append((Prefix(_BYTES[data[at:end]])(start, stop), start + at, stop + at))
        at = end
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (none.astype(np.uint64), none, none)


def lowered(text: str | None) -> np.ndarray:
    """A text's bytes in UTF-8 with A-Z in lower case."""
    return np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
