"""Word and shingle hashes of many texts at once, as numpy arrays.

Used inside Arrow batches. Texts are handled in blocks of some hundred kilobytes, so
memory does not depend on the batch, and each text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of a block, and values taken out of an Arrow column at once.
BLOCK_BYTES, VALUES = 1 << 18, 256
SHINGLE = 5
_FACTOR = 0x9E3779B97F4A7C15 | 1
_WINDOW = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(separator: np.ndarray) -> np.ndarray:
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    values = mix((lower + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))
    values[separator] = 0
    return values


def separators(*, letters_only: bool = False) -> np.ndarray:
    """Which bytes end a word: white space, or everything but letters and bytes beyond ASCII."""
    out = np.zeros(256, dtype=bool)
    out[[9, 10, 11, 12, 13, 32]] = True
    if letters_only:
        out[:128] = True
        out[65:91] = False
        out[97:123] = False
    return out


class Hasher:
    """Hashes of the lower-cased (A-Z) words of byte texts."""

    def __init__(self, separator: np.ndarray | None = None):
        self.separator = separators() if separator is None else separator
        self.values = _byte_values(self.separator)
        self._grow(BLOCK_BYTES + 1)

    def _grow(self, n: int) -> None:
        inverse = pow(_FACTOR, -1, 1 << 64)
        self.power = np.full(n, _FACTOR, dtype=np.uint64)
        self.inverse = np.full(n, inverse, dtype=np.uint64)
        self.power[0] = self.inverse[0] = 1
        self.power = np.cumprod(self.power, dtype=np.uint64)
        self.inverse = np.cumprod(self.inverse, dtype=np.uint64)

    def _window(self, data: np.ndarray, prefixes: tuple[int, ...]):
        if len(data) + 1 > len(self.power):
            self._grow(len(data) + 1)
        gap = self.separator[data]
        edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
        starts, ends = edge[0::2], edge[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        hashes = []
        for size in (0, *prefixes):
            stop = ends if not size else np.minimum(starts + size, ends)
            raw = (sums[stop] - sums[starts]) * self.inverse[starts]
            hashes.append(mix(raw + (stop - starts).astype(np.uint64) * np.uint64(_FACTOR) + np.uint64(size)))
        return starts, hashes

    def words(self, texts: list[bytes], prefixes: tuple[int, ...] = ()):
        """Index of the text and hash of each word, in order; then one hash array per prefix length in bytes."""
        buffer = b"\n".join(texts) + b"\n"
        data = np.frombuffer(buffer, dtype=np.uint8)
        at, starts, hashes = 0, [], []
        while at < len(data):
            stop = min(len(data), at + BLOCK_BYTES)
            if stop < len(data):
                gaps = np.flatnonzero(self.separator[data[at:stop]])
                while not len(gaps):  # one word longer than a block
                    stop = min(len(data), stop + BLOCK_BYTES)
                    gaps = np.flatnonzero(self.separator[data[at:stop]])
                stop = at + int(gaps[-1]) + 1
            found, hashed = self._window(data[at:stop], prefixes)
            starts.append(found + at)
            hashes.append(hashed)
            at = stop
        start = np.concatenate(starts)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        owner = np.searchsorted(first, start, side="right") - 1
        return owner, *[np.concatenate([h[k] for h in hashes]) for k in range(1 + len(prefixes))]


def _values(column: pa.Array) -> Iterator[str | None]:
    for at in range(0, len(column), VALUES):
        yield from column.slice(at, VALUES).to_pylist()


def blocks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes in blocks of bounded size (one long text is a block), with the index of the first; null is empty."""
    block, size, first = [], 0, 0
    for i, value in enumerate(_values(column)):
        raw = (value or "").encode("utf-8", "surrogatepass")
        if block and size + len(raw) > BLOCK_BYTES:
            yield first, block
            block, size, first = [], 0, i
        block.append(raw)
        size += len(raw)
    if block:
        yield first, block


def shingle_sets(hasher: Hasher, texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the 5-word shingles of each text.

    A text with fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    owner, word = hasher.words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    n = max(0, len(word) - SHINGLE + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE):
        total += word[k : k + n] * _WINDOW[k]
    windows = mix(total + np.uint64(SHINGLE))
    out = []
    for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
        begin = end - count
        if count >= SHINGLE:
            own = np.sort(windows[begin : end - SHINGLE + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif count:
            out.append(mix(np.array([(word[begin:end] * _WINDOW[:count]).sum(dtype=np.uint64) + np.uint64(count)], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
