"""Periodic runs in word sequences by dyadic square catching.

A run is a stretch of words with smallest period q, at least two periods long,
that no neighbouring word extends. Its first period holds a whole block of
2^l words that starts at a multiple of 2^l, with 2^(l+1) <= q < 2^(l+2). Such a
block starts a catcher when its last word is there: as words are appended, the
suffixes of 2^l words that lie 2^(l+1) to 2^(l+2) words behind the block are
compared with it, so every appended word meets two live catchers a level. A
suffix that equals its catcher's block is part of a square if the words around
both agree for long enough; squares of one period that touch are one run.
Periods under 8 words need no blocks: each word meets the words 1 to 7 before.

Words are appended in bulk: all words of a batch of texts take a level's
comparisons together, as array rows (block number, place in the block). Suffixes
are compared by 64-bit hashes built from two halves, extensions by prefix
hashes modulo two primes, both in memory linear in the words of the batch and
time n log n. Texts of a batch are separated by words that equal nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.wordhash import mix

BATCH_BYTES = 1 << 20
DIRECT = 8
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_PRIMES = ((2147483647, 1103515245), (2147483629, 1299709827))
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Prefixes:
    """Equality of two windows of one sequence, q places apart."""

    def __init__(self, ids: np.ndarray):
        self.sums, self.powers = [], []
        for prime, base in _PRIMES:
            p = _U(prime)
            power = np.ones(len(ids) + 1, _U)
            size, step = 1, base
            while size < len(power):
                power[size:2 * size] = power[:size][:len(power) - size] * _U(step) % p
                size, step = 2 * size, step * step % prime
            sums = np.zeros(len(ids) + 1, _U)
            np.cumsum(mix(ids.astype(_U) + _U(base)) % p * power[:-1] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(power)

    def equal(self, at: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
        """Whether the windows at ``at`` and ``at + q`` agree; False where one is not in the sequence."""
        inside = (at >= 0) & (at + q + length < len(self.sums[0]))
        a = np.where(inside, at, 0)
        b = np.where(inside, at + q, 0)
        same = inside
        for (prime, _), s, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            p = _U(prime)
            left, right = (s[a + length] + p - s[a]) % p, (s[b + length] + p - s[b]) % p
            same = same & (left * power[b - a] % p == right)
        return same


def _stretches(ids: np.ndarray, q: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Maximal stretches of places whose word is the one ``q`` places on."""
    if len(ids) > q:
        same = np.concatenate(([False], ids[:-q] == ids[q:], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        a, b = edge[::2], edge[1::2]
        long = b - a >= max(q, least - q)
        yield a[long], b[long]


def _caught(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all suffixes that equal a live catcher's block."""
    size = 1 << level
    junk = mix(np.arange(-len(hashes) % size, dtype=_U) + _U(len(hashes) + 12345))
    rows = np.concatenate((hashes, junk)).reshape(-1, size)
    starts, distances = [], []
    for behind in (2, 3):
        if len(rows) > behind:
            block, place = np.nonzero(rows[behind:] == rows[:-behind, :1])
            starts.append(block * size)
            distances.append(behind * size + place)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(distances)


def runs_of(ids: np.ndarray, first: np.ndarray, lengths: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of at least ``least`` words, in order.

    ``ids`` holds the word numbers of texts one after another, longest text
    first, each followed by a number found nowhere else; ``first`` has the
    start of each text, ``lengths`` its words."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(1, DIRECT):
        for a, b in _stretches(ids, q, least):
            found.append((a, b + q, np.full(len(a), q)))
    hashes, prefixes, level = mix(ids.astype(_U)), None, 0
    longest = int(lengths[0]) if len(lengths) else 0
    while 4 << level <= longest:
        if 2 << level >= DIRECT:
            start, q = _caught(hashes, level)
            text = np.searchsorted(first, start, "right")
            inside = text == np.searchsorted(first, start + q, "right")
            start, q = start[inside], q[inside]
            if len(start):
                prefixes = prefixes or _Prefixes(ids)
                order = np.lexsort((start, q))
                start, q = start[order], q[order]
                new = np.ones(len(start), bool)  # catchers of neighbouring blocks at one distance caught the same square
                new[1:] = (q[1:] != q[:-1]) | (start[1:] != start[:-1] + (1 << level))
                a, b, q = start[new], start[np.append(new[1:], True)] + (1 << level), q[new]
                for k in range(level - 1, -1, -1):
                    a = a - (prefixes.equal(a - (1 << k), q, 1 << k).astype(np.int64) << k)
                    b = b + (prefixes.equal(b, q, 1 << k).astype(np.int64) << k)
                long = b - a >= np.maximum(q, least - q)
                found.append((a[long], (b + q)[long], q[long]))
        # the next level, for the texts that are long enough for it
        level += 1
        n = int((lengths[lengths >= 4 << level] + 1).sum())
        half = 1 << (level - 1)
        n = max(0, min(len(hashes) - half, n - 2 * half + 1))
        hashes = mix(hashes[:n] * _ODD + hashes[half:half + n])
    start, end, period = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in range(3))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # a stretch caught with a multiple of its period as well is one run
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def of_texts(texts: list[bytes | None], least: int) -> pa.RecordBatch:
    """n_words, runs and collapsed of each text (its UTF-8 bytes)."""
    words = [(t or b"").split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-lengths, kind="stable")
    total = int(lengths.sum())
    flat = np.empty(total, object)
    flat[:] = [w for i in order for w in words[i]]
    number, _ = pd.factorize(flat)
    size = lengths[order]
    first = np.cumsum(size + 1) - size - 1
    place = np.arange(total) + np.repeat(np.arange(len(size)), size)
    ids = np.full(total + len(size), -1, np.int64)
    ids[place] = number
    ends = first + size
    ids[ends] = total + np.arange(len(size))
    start, end, period = runs_of(ids, first, size, least)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, end, -1)
    kept = np.cumsum(cover[:-1])[place] == 0
    whose = np.searchsorted(first, start, "right") - 1  # in order of length
    n_runs = np.bincount(whose, minlength=len(size))
    rank = np.argsort(order, kind="stable")  # where each text lies in that order
    at = np.cumsum(n_runs) - n_runs
    pick = np.concatenate([np.arange(at[r], at[r] + n_runs[r]) for r in rank]) if len(start) else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(n_runs[rank])))
    runs = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays([pa.array((start - first[whose])[pick]), pa.array((end - start)[pick]), pa.array(period[pick])],
                                   ["start", "length", "period"]))
    dropped = np.zeros(len(size), bool)
    dropped[whose] = True
    word_at = np.cumsum(size) - size
    collapsed = []
    for i, r in enumerate(rank.tolist()):
        mine = words[i]
        if dropped[r]:
            mine = [w for w, k in zip(mine, kept[word_at[r]:word_at[r] + size[r]].tolist(), strict=True) if k]
        collapsed.append(b" ".join(mine))
    return pa.RecordBatch.from_arrays([pa.array(lengths), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                                      ["n_words", "runs", "collapsed"])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``runs`` (all runs of at
    least ``least`` words, by start, then period: start as a word number from
    0, length, period) and ``collapsed`` (the words joined by one space without
    those that a run holds after its first period).

    Words are separated by ASCII white space and compared byte by byte. A null
    or empty text, or one of white space alone, has no words, no runs and an
    empty ``collapsed``. A text of any length is one sequence; runs that share
    words are all reported. Every row is judged by itself, so repeated rows and
    null ids are rows like any other; an empty table gives an empty result.
    Other columns are not read. Nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").cast(pa.binary())
            size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < b.num_rows:
                base = size[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(size, base + BATCH_BYTES, "right")))
                part = of_texts(text.slice(at, end - at).to_pylist(), least)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, end - at), *part.columns], ["id", *part.schema.names])
                at = end

    return rows.mapInArrow(walk, f"id {dict(rows.dtypes)['id']}, n_words long, "
                                 "runs array<struct<start: long, length: long, period: long>>, collapsed string")
