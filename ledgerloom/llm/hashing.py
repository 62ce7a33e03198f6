"""Hashes of words, shingles and byte windows over whole batches of texts.

All texts of a batch are laid end to end and hashed together with numpy. A substring's hash comes
from prefix sums of a polynomial modulo 2**64 with an odd base, so any substring costs two lookups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import xxhash

BASE = 0x9E6C63D0876A9A47  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)
BATCH_BYTES = 1 << 18  # texts hashed together; a longer text is hashed alone

LONG_WORD = 64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that leaves no pattern (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Substrings:
    """Hashes of any substrings of one byte array."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table(BASE, len(data))[: len(data)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = _table(_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * back[starts])


def batches(texts: Sequence[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def lower_bytes(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 with A-Z in lower case; None counts as empty."""
    return [b"" if t is None else t.encode().lower() for t in texts]


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of every word ``[^\\x20\\x09-\\x0D]+`` of the texts, in order.

    Words of more than ``LONG_WORD`` bytes are hashed one by one: a polynomial modulo a power of two has words of
    1024 bytes and more that are made to collide under any base.
    """
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    hashes = Substrings(data).hashes(starts, ends)
    for at in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        hashes[at] = xxhash.xxh3_64_intdigest(joined[starts[at] : ends[at]])
    return np.searchsorted(text_ends, starts, side="right"), hashes


def shingle_hashes(texts: Sequence[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of every shingle of ``words`` words, with repeats.

    A text of fewer words, but at least one, is one shingle of all its words.
    """
    of, hashes = word_hashes(texts)
    n = len(of)
    if n == 0:
        return of, hashes
    multiplier = np.uint64(0xD6E8FEB86659FD93)
    span = max(n - words + 1, 0)
    joined = hashes[:span].copy()
    for i in range(1, words):
        joined = joined * multiplier + hashes[i : i + span]
    whole = of[:span] == of[words - 1 : words - 1 + span] if span else np.zeros(0, dtype=bool)
    counts = np.bincount(of, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < words))
    first = np.concatenate(([0], np.cumsum(counts)))
    extra = np.zeros(len(short), dtype=np.uint64)
    for at, text in enumerate(short):
        total = 0
        for h in hashes[first[text] : first[text + 1]].tolist():
            total = (total * 0xD6E8FEB86659FD93 + h) & 0xFFFFFFFFFFFFFFFF
        extra[at] = total
    found = np.concatenate((of[:span][whole], short))
    values = mix(np.concatenate((joined[whole], extra)))
    order = np.argsort(found, kind="stable")
    return found[order], values[order]


def shingle_sets(texts: Sequence[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for start, end in batches(texts):
        of, hashes = shingle_hashes(texts[start:end], words)
        order = np.lexsort((hashes, of))
        of, hashes = of[order], hashes[order]
        fresh = np.ones(len(of), dtype=bool)
        fresh[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
        of, hashes = of[fresh], hashes[fresh]
        bounds = np.searchsorted(of, np.arange(end - start + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield hashes[a:b]
