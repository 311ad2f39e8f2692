"""64-bit hashes of all words of a batch of texts, computed on byte arrays.

A word is a run of bytes that are not separators. Its hash is a polynomial
over randomly coded bytes (taken from prefix sums, so any leading part of a
word has its hash too), finished by a mixer. Texts are processed whole, in
chunks of bounded size cut between words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

CHUNK = 1 << 19
LONG_WORD = 1 << 16
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5
_CODES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(i).isalnum() for i in range(128)]

_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK) + 1
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _chunk(buf: np.ndarray, white: np.ndarray, prefixes: Sequence[int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts and hashes of the words of a byte array, and for each prefix
    length the hash of that many leading bytes (0 if the word isn't longer)."""
    is_white = white[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], is_white, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _tables(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_CODES[buf] * up[:len(buf)], out=sums[1:])
    base, back, length = sums[starts], down[starts], ends - starts
    words = mix((sums[ends] - base) * back + length.astype(np.uint64))
    for i in np.flatnonzero(length > LONG_WORD):
        words[i] = _digest(buf[starts[i]:ends[i]].tobytes())
    leading = []
    for k in prefixes:
        at = np.minimum(starts + k, len(buf))
        leading.append(np.where(length > k, mix((sums[at] - base) * back + _U((k << 32) + 1)), _U(0)))
    return starts, words, leading


def _digest(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _cuts(data: bytes, white: np.ndarray) -> Iterator[bytes]:
    """Pieces of a long text, cut at separators only."""
    view, at = np.frombuffer(data, np.uint8), 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            here = np.flatnonzero(white[view[at:end]])
            if len(here):
                end = at + int(here[-1]) + 1
            else:  # one word longer than a chunk
                while end < len(data):
                    more = np.flatnonzero(white[view[end:end + CHUNK]])
                    if len(more):
                        end += int(more[0])
                        break
                    end = min(end + CHUNK, len(data))
        yield data[at:end]
        at = end


def hashed_words(texts: Sequence[str | None], white: np.ndarray = WHITE, fold: np.ndarray | None = LOWER,
                 prefixes: Sequence[int] = ()) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For consecutive groups of texts: index of the first text, bounds of each
    text's words (one more than texts), word hashes, prefix hashes. A null
    text has no words."""
    group: list[bytes] = []
    first = size = 0

    def done() -> tuple:
        data = b"\n".join(group)
        buf = np.frombuffer(data, np.uint8)
        if fold is not None:
            buf = fold[buf]
        starts, words, leading = _chunk(buf, white, prefixes)
        ends = np.cumsum([len(g) + 1 for g in group])
        bounds = np.concatenate(([0], np.searchsorted(starts, ends)))
        return first, bounds, words, leading

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if group and size + len(data) + 1 > CHUNK:
            yield done()
            group, first, size = [], i, 0
        if len(data) < CHUNK:
            group.append(data)
            size += len(data) + 1
            continue
        words, leading = [], []
        for part in _cuts(data, white):
            if len(part) > 2 * CHUNK:  # a single word
                words.append(np.array([_digest(part if fold is None else fold[np.frombuffer(part, np.uint8)].tobytes())], np.uint64))
                head = np.frombuffer(part[:max(prefixes, default=0) + 1], np.uint8)
                leading.append(_chunk(head if fold is None else fold[head], white, prefixes)[2])
                continue
            buf = np.frombuffer(part, np.uint8)
            _, w, p = _chunk(buf if fold is None else fold[buf], white, prefixes)
            words.append(w)
            leading.append(p)
        one = np.concatenate(words) if words else np.zeros(0, np.uint64)
        yield i, np.array([0, len(one)]), one, [np.concatenate([p[k] for p in leading]) for k in range(len(prefixes))]
        group, first, size = [], i + 1, 0
    if group:
        yield done()
