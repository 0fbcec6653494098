"""64-bit hashes of words and word shingles, for whole batches of texts at once.

A word is a maximal run of characters other than space and ``\\t \\n \\v \\f \\r``,
with A-Z lower-cased and nothing else changed. In UTF-8 those characters are single
bytes that occur in no longer sequence, so bytes are enough. All arithmetic is modulo
2**64; two different words or shingles of a corpus of 10**9 distinct ones share a
hash with a chance of about 3 %, a given pair with one of 5e-20.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are hashed together up to about this many bytes, a longer one by itself.
CHUNK_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    start = np.uint64((seed * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF)
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_BYTE = stream(1, 256)[_LOWER]
_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), 0x5851F42D4C957F2D, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first text, end text, joined bytes, start of each text in them) of each chunk."""
    first, size, parts = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if parts and size + len(raw) > CHUNK_BYTES:
            yield first, i, b"\n".join(parts), _starts(parts)
            first, size, parts = i, 0, []
        parts.append(raw)
        size += len(raw) + 1
    if parts:
        yield first, len(texts), b"\n".join(parts), _starts(parts)


def _starts(parts: list[bytes]) -> np.ndarray:
    return np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])


def separators(alphanumeric: bool = False) -> np.ndarray:
    """Which bytes stand between words: white space, or with ``alphanumeric`` every ASCII
    character that is no letter or digit."""
    if not alphanumeric:
        return _SEPARATOR
    return np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(raw: bytes, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (byte offsets) of every word."""
    b = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~separator[b]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    lengths = ends - starts
    at = np.flatnonzero(inside[1:-1])
    place = at - np.repeat(starts, lengths)
    values = _BYTE[b[at]]
    values *= _powers_to(int(lengths.max()))[place]
    first = np.cumsum(lengths) - lengths
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), starts, ends


def word_lists(texts: list[str | None], separator: np.ndarray = _SEPARATOR) -> Iterator[tuple[int, np.ndarray]]:
    """(position of the text, hashes of its words in order) of every text."""
    for first, end, raw, begin in chunks(texts):
        hashes, starts, _ = words_of(raw, separator)
        cuts = np.append(np.searchsorted(starts, begin), len(starts))
        for i in range(first, end):
            yield i, hashes[cuts[i - first] : cuts[i - first + 1]]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; fewer words count as one run."""
    n = len(words)
    if not n:
        return words
    step = min(width, n)
    total = np.full(n - step + 1, step, np.uint64)
    for k in range(step):
        total *= np.uint64(0x9FB21C651E98DF25)
        total += words[k : n - step + 1 + k]
    return mix(total)
