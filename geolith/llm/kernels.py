"""Word, shingle and n-gram hashes of many texts at once, over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Texts are taken together up to this many bytes; a longer text stands alone.
BLOCK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

#: ASCII white space: U+0009 to U+000D and U+0020.
SPACE = np.zeros(256, bool)
SPACE[[*range(9, 14), 32]] = True
#: Lower-case form of each byte; only A-Z change.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Digits, ASCII letters and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def blocks(texts: Sequence[str | None] | pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts in UTF-8) of runs of texts of about `limit` bytes; null counts as empty.

    Of an Arrow array, few texts at a time become Python's.
    """
    held: list[bytes] = []
    size = first = 0
    for at in range(0, len(texts), 256):
        part = texts[at : at + 256]
        for k, text in enumerate(part.to_pylist() if isinstance(part, pa.Array) else part, at):
            if held and size > limit:
                yield first, held
                held, size, first = [], 0, k
            held.append((text or "").encode())
            size += len(held[-1])
    if held:
        yield first, held


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with a newline after each text, and where each text starts and ends."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), ends - sizes, ends


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        size = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 2))
        out = np.full(size, _BASE if which == "up" else _INVERSE, np.uint64)
        out[0] = 1
        _powers[which] = np.multiply.accumulate(out)
    return _powers[which][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all its bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any stretches of the bytes, from one pass over them."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power("up", len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * _power("down", len(self.sums))[starts])

    def ngrams(self, n: int) -> np.ndarray:
        """Of the n bytes from each place on; not mixed, the high bits serve."""
        m = max(len(self.sums) - n, 0)
        return (self.sums[n:] - self.sums[:m]) * _power("down", len(self.sums))[:m] if m else np.zeros(0, np.uint64)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return edges[::2], edges[1::2]


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of values[start:end] for each pair; each depends on its own values alone."""
    out = np.zeros((len(starts), *values.shape[1:]), np.float64)
    some = ends > starts
    if some.any():
        edges = np.stack([starts[some], ends[some]], 1).ravel()
        padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
        out[some] = np.add.reduceat(padded, edges, axis=0)[::2]
    return out
